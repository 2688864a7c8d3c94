"""Benchmark decontamination by a positional inverted index, in built-in functions only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import PLAIN_WORD, UPPER, broadcast_if_small, saved, stored, text_or_empty

WINDOW = 10


def _words(text: str):
    return F.regexp_extract_all(F.translate(text_or_empty(text), UPPER, UPPER.lower()), F.lit(PLAIN_WORD), F.lit(0))


def item_windows(items: DataFrame, key: str = "item_id", text: str = "text", length: int = WINDOW) -> DataFrame:
    """``item, words``: every run of ``length`` words of each item; an item of fewer words, but not none, is one."""
    cut = items.select(F.col(key).alias("item"), _words(text).alias("all"))
    starts = F.sequence(F.lit(1), F.greatest(F.size("all") - (length - 1), F.lit(1)))
    runs = cut.where(F.size("all") > 0).withColumn("at", F.explode(starts))
    return runs.select("item", F.expr(f"slice(all, at, {length})").alias("words"))


@dataclass(frozen=True)
class PositionalIndex:
    """Postings of a document set, written out once.

    ``postings``: term, ref, pos, one row per occurrence. Each input partition is a segment, sorted by term, so that
    building shuffles nothing, a very frequent term is spread over all segments, and a look-up by term skips row
    groups. ``documents``: ref (one per input row), key, n_words. ``terms``: word, term, n (occurrences, 0 if none).
    """

    postings: DataFrame
    documents: DataFrame
    terms: DataFrame

    @classmethod
    def build(
        cls, docs: DataFrame, vocabulary: DataFrame | None = None, key: str = "doc_id", text: str = "text"
    ) -> PositionalIndex:
        """Index ``docs`` for all words, or for those in column ``word`` of ``vocabulary``: a word that no query uses
        is never looked up, so its postings need not be kept.

        Null or empty text: a document of no words. Null and repeated keys: each row is a document of its own.
        """
        source = docs.select(
            F.monotonically_increasing_id().alias("ref"), F.col(key).alias("key"), _words(text).alias("words")
        )
        if vocabulary is None:
            vocabulary = source.select(F.explode("words").alias("word"))
        words = vocabulary.select("word").where("word IS NOT NULL").distinct()
        numbered = saved(words.withColumn("term", F.monotonically_increasing_id()))
        # The first entry of each document stands for the document itself, so that one pass over the texts does.
        entries = source.select(
            "ref", "key", F.size("words").alias("n"), F.expr("array_insert(words, 1, string(null))").alias("all")
        ).select("ref", "key", "n", F.posexplode("all").alias("at", "word"))
        found = entries.join(broadcast_if_small(numbered), "word", "left").where("term IS NOT NULL OR at = 0")
        postings = stored(
            found.select(
                "term",
                "ref",
                F.expr("IF(at = 0, NULL, at - 1)").alias("pos"),
                F.expr("IF(at = 0, key, NULL)").alias("key"),
                F.expr("IF(at = 0, n, NULL)").cast("long").alias("n_words"),
            ).sortWithinPartitions("term", "ref", "pos")
        )
        counted = postings.where("term IS NOT NULL").groupBy("term").agg(F.count(F.lit(1)).alias("n"))
        terms = saved(numbered.join(counted, "term", "left").select("word", "term", F.expr("coalesce(n, 0L)").alias("n")))
        return cls(
            postings.where("term IS NOT NULL").select("term", "ref", "pos"),
            postings.where("term IS NULL").select("ref", "key", "n_words"),
            terms,
        )

    def _looked_up(self, queries: DataFrame) -> DataFrame:
        """``query, size, lists``: the terms of each query as (n, offset, term), rarest first. Queries with a word
        that the documents don't have are left out: nothing holds them."""
        terms = self.terms.where("n > 0")
        entries = queries.select("query", F.size("words").alias("size"), F.posexplode("words").alias("offset", "word"))
        lists = (
            entries.join(terms, "word")
            .groupBy("query", "size")
            .agg(F.array_sort(F.collect_list(F.struct("n", "offset", "term"))).alias("lists"))
        )
        return saved(lists.where("size(lists) = size"))

    def phrases(self, queries: DataFrame) -> DataFrame:
        """``query, ref, start, size``: every place where the words of a query (``query, words``; query unique) stand
        consecutively.

        The list of a query's rarest term, shifted by the term's offset, gives the places to look at; the list of the
        next rarest, shifted likewise, keeps those that both agree on; the few places left are intersected with
        all other lists at once. Lists of frequent terms so meet places in documents that hold the rare ones only.
        """
        lists = self._looked_up(queries)
        first = lists.select("query", "size", F.expr("lists[0].offset").alias("offset"), F.expr("lists[0].term").alias("term"))
        places = (
            self.postings.join(broadcast_if_small(first), "term")
            .select("query", "size", "ref", (F.col("pos") - F.col("offset")).alias("start"))
            .where("start >= 0")
        )
        second = lists.where("size > 1").select(
            "query", F.expr("lists[1].offset").alias("offset"), F.expr("lists[1].term").alias("term")
        )
        wanted = places.where("size > 1").join(broadcast_if_small(second), "query")
        wanted = wanted.select("query", "size", "ref", "start", "term", (F.col("start") + F.col("offset")).alias("pos"))
        used = self.postings.join(broadcast_if_small(second.select("term").distinct()), "term", "left_semi")
        pairs = saved(wanted.join(used, ["ref", "term", "pos"]).select("query", "size", "ref", "start"))
        rest = lists.where("size > 2").select("query", F.expr("slice(lists, 3, size)").alias("rest"))
        open_places = pairs.where("size > 2").join(broadcast_if_small(rest), "query")
        open_places = open_places.select("query", "size", "ref", "start", F.explode("rest").alias("l"))
        open_places = open_places.select(
            "query", "size", "ref", "start", F.col("l.term").alias("term"), (F.col("start") + F.col("l.offset")).alias("pos")
        )
        held = self.postings.join(broadcast_if_small(pairs.select("ref").distinct()), "ref", "left_semi")
        agreed = open_places.join(held, ["ref", "term", "pos"]).groupBy("query", "size", "ref", "start")
        whole = agreed.agg(F.count(F.lit(1)).alias("n")).where("n = size - 2").drop("n")
        ones = places.where("size = 1")
        return ones.unionByName(pairs.where("size = 2")).unionByName(whole).select("query", "ref", "start", "size")

    def near(self, queries: DataFrame, span: int) -> DataFrame:
        """``query, ref, pos``: occurrences of the query's rarest term for which some run of ``span`` consecutive words
        holds that occurrence and every distinct word of the query, in any order.

        Postings of the other terms meet the rarest one's in blocks of ``span`` positions, each with its two
        neighbours, so a place sees at most 2 * span - 1 words however frequent a term is.
        """
        lists = self._looked_up(queries)
        terms = lists.select("query", F.expr("array_distinct(transform(lists, l -> l.term))").alias("terms"))
        first = terms.select("query", F.expr("terms[0]").alias("term"), F.size("terms").alias("n_terms"))
        places = self.postings.join(broadcast_if_small(first), "term").withColumnRenamed("pos", "at")
        every = terms.select("query", F.explode("terms").alias("term"))
        wanted = places.drop("term").join(broadcast_if_small(every), "query")
        blocks = F.explode(F.expr(f"transform(array(-1, 0, 1), d -> at div {span} + d)"))
        wanted = wanted.withColumn("block", blocks)
        held = self.postings.withColumn("block", F.expr(f"pos div {span}"))
        met = wanted.join(held, ["ref", "term", "block"]).where(f"abs(pos - at) < {span}")
        around = met.groupBy("query", "ref", "at", "n_terms").agg(F.collect_list(F.struct("pos", "term")).alias("seen"))
        inside = f"filter(seen, y -> y.pos BETWEEN x.pos AND x.pos + {span - 1})"
        fits = f"exists(filter(seen, x -> x.pos <= at AND at < x.pos + {span}), x -> size(array_distinct(transform({inside}, y -> y.term))) = n_terms)"
        return around.where(fits).select("query", "ref", F.col("at").alias("pos"))


def contamination(
    docs: DataFrame,
    items: DataFrame,
    length: int = WINDOW,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """Per document: n_words, n_hit (words inside an occurrence of a window), n_items and items_sha256 (items with
    an occurring window; their ids sorted as strings, joined by commas, hashed) and contaminated (n_hit > 0).

    Documents with the same set of occurring windows have the same items, so the ids are gathered once per such set,
    and windows that many items share are searched once. Hit words are counted from the gaps between starts, row by
    row; nothing holds more than the windows of one document or the items of one benchmark.

    Null or empty text: no words, not contaminated, the hash of no ids. Null and repeated document ids: row by row.
    Rows of one item id are one item; an item without id marks words, but is in no list. No documents: no rows;
    no items: nothing is contaminated. Other columns are not read. Whole texts of any length are indexed.
    """
    windows = item_windows(items, item_key, item_text, length)
    queries = saved(windows.select("words").distinct().withColumn("query", F.monotonically_increasing_id()))
    index = PositionalIndex.build(docs, queries.select(F.explode("words").alias("word")), key, text)
    found = saved(index.phrases(queries))

    before = Window.partitionBy("ref").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    longest = found.groupBy("ref", "start").agg(F.max(F.expr("start + size")).alias("end"))
    reached = longest.withColumn("from", F.greatest("start", F.coalesce(F.max("end").over(before), F.lit(0))))
    hits = reached.groupBy("ref").agg(F.sum(F.greatest(F.col("end") - F.col("from"), F.lit(0))).alias("n_hit"))

    of_doc = found.select("ref", "query").distinct().groupBy("ref").agg(F.array_sort(F.collect_list("query")).alias("set"))
    of_doc = saved(of_doc.select("ref", F.sha2(F.to_json("set"), 256).alias("class"), "set"))
    sets = of_doc.groupBy("class").agg(F.first("set").alias("set"))
    ids = windows.join(queries, "words").select("query", F.col("item").cast("string").alias("item")).distinct()
    members = sets.select("class", F.explode("set").alias("query")).join(ids, "query")
    lists = members.groupBy("class").agg(F.array_sort(F.collect_set("item")).alias("items"))
    lists = lists.select(
        "class", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256")
    )
    marked = hits.join(of_doc.select("ref", "class").join(lists, "class", "left"), "ref")
    return index.documents.join(marked, "ref", "left").select(
        F.col("key").alias(key),
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )
