"""Language identification: text likelihoods fused with declared language, address suffix and host priors."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import (
    column_slices,
    in_small_batches,
    lower_ascii,
    saved,
    slices,
    text_buffers,
    text_or_empty,
    tidy,
)

# Labelled rows on which the text model is fitted, spread over the languages, and of each language at least so many.
TRAIN_ROWS = 20_000
LEAST_ROWS = 200
# Three-byte windows are hashed into so many cells; the model is a table of cells by languages.
CELLS = 1 << 16
# Neighbouring windows repeat the same evidence: a text counts as if it had at most so many of them.
EVIDENCE = 60.0
# Rows that the level above counts as, at each level of the priors.
PRIOR_WEIGHT = 20.0
LEAST_CONFIDENCE = 0.5
SLICE_BYTES = 1 << 19


def _cells(column) -> tuple[np.ndarray, np.ndarray]:
    """The cell of each three-byte window, and the number of windows up to each text border.

    Letters count, everything else (ASCII digits, punctuation, white space) is one blank; runs of blanks are one.
    """
    data, offsets = text_buffers(column)
    data = lower_ascii(data)
    letter = ((data >= 97) & (data <= 122)) | (data >= 128)
    data = np.where(letter, data, 32).astype(np.uint8)
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    upto = np.concatenate([[0], np.cumsum(keep)])[offsets]
    kept = data[keep].astype(np.uint32)
    if len(kept) < 3:
        return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
    window = kept[:-2] << np.uint32(16) | kept[1:-1] << np.uint32(8) | kept[2:]
    cells = (window * np.uint32(2654435761)) >> np.uint32(16)
    # Windows across a text border are dropped.
    counts = np.maximum(np.diff(upto) - 2, 0)
    ends = np.cumsum(counts)
    inside = np.arange(counts.sum()) - np.repeat(ends - counts, counts) + np.repeat(upto[:-1], counts)
    return cells[inside], np.concatenate([[0], ends])


def _tag(language: Column) -> Column:
    """The language of a label or declaration, in lower case and without region or script."""
    return F.substring_index(F.substring_index(F.lower(F.trim(language.cast("string"))), "-", 1), "_", 1)


class TextModel:
    """Log-likelihoods of three-byte windows by language, fitted on labelled rows."""

    def __init__(self, languages: Sequence[str], table: np.ndarray):
        self.languages = list(languages)
        self.table = table

    @staticmethod
    def fit(labelled: DataFrame, text: str = "text", label: str = "lang", rows: int = TRAIN_ROWS) -> TextModel:
        """Window counts by label, summed in Spark; only the table comes to the driver.

        Every label is learnt; those that differ in region or script only are one. Of each about ``rows`` / labels rows are read, LEAST_ROWS at least, and all where it
        has no more.
        """
        tagged = in_small_batches(labelled).select(_tag(F.col(label)).alias("l"), text_or_empty(text).alias("t"))
        known = tagged.where("l <> ''")
        counted = known.groupBy("l").count().collect()
        languages = sorted(r["l"] for r in counted)
        total = sum(r["count"] for r in counted)
        if not languages:
            return TextModel([], np.zeros((CELLS, 0), np.float32))
        place = {language: i for i, language in enumerate(languages)}

        def count(batches):
            import pyarrow as pa

            for batch in batches:
                for part in slices(batch, SLICE_BYTES):
                    cells, upto = _cells(part.column(1))
                    row = np.array([place[v] for v in part.column(0).to_pylist()])
                    # However many languages there are, a task holds the cells of one slice.
                    at, n = np.unique(np.repeat(row, np.diff(upto)) * CELLS + cells, return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(n, pa.int64())], names=["cell", "n"])

        sample = known
        if total > rows:
            # A label with twice its part or fewer rows is read whole, so that none can be left without a row.
            part = max(LEAST_ROWS, rows // len(languages))
            shares = {r["l"]: part / r["count"] for r in counted if r["count"] > 2 * part}
            if shares:
                share = F.create_map(*[F.lit(x) for pair in shares.items() for x in pair])
                sample = sample.where(F.rand(seed=11) < F.coalesce(F.try_element_at(share, "l"), F.lit(1.0)))
        parts = sample.mapInArrow(tidy(count), "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
        sums = np.zeros(len(languages) * CELLS)
        sums[parts["cell"].to_numpy()] = parts["n"].to_numpy()
        sums = sums.reshape(len(languages), CELLS)
        table = np.log((sums + 0.1) / (sums.sum(1, keepdims=True) + 0.1 * CELLS))
        return TextModel(languages, np.ascontiguousarray(table.T.astype(np.float32)))

    def likelihoods(self, text: Column) -> Column:
        """Per text: the mean log-likelihood of its windows by language, then the number of windows."""
        shared = self.table
        width = shared.shape[1]

        @F.arrow_udf("array<double>")
        def score(column):
            import pyarrow as pa

            out = np.zeros((len(column), width + 1))
            for start, end in column_slices(column, SLICE_BYTES):
                cells, upto = _cells(column.slice(start, end - start))
                counts = np.diff(upto)
                some = counts > 0
                part = out[start:end]
                part[:, -1] = counts
                if len(cells):
                    for i in range(width):
                        part[some, i] = np.add.reduceat(shared[cells, i], upto[:-1][some], dtype=np.float64) / counts[some]
            borders = pa.array(np.arange(len(column) + 1, dtype=np.int32) * (width + 1))
            return pa.ListArray.from_arrays(borders, pa.array(out.ravel()))

        return score(text)


def _prior(counts: Column, total: Column, above: Column, weight: float = PRIOR_WEIGHT) -> Column:
    """Counts of one level drawn towards the shares of the level above."""
    return F.zip_with(counts, above, lambda n, p: (n + weight * p) / (total + weight))


def identify(
    rows: DataFrame,
    model: TextModel,
    text: Column,
    declared: Column,
    suffix: Column,
    host: Column,
    prefix: str = "",
) -> DataFrame:
    """``rows`` with language, confidence and known added (each name after ``prefix``).

    The posterior of a language is the product of: the text's likelihood, tempered to ``EVIDENCE`` windows; the
    probability of what is declared, by how often declarations agree with the text in the whole table; and the
    host's prior. Priors are shares of the text's own best guess, counted by grouped aggregation over all rows: a
    host's counts are drawn towards its suffix's shares, those towards the table's, those towards even shares.

    known is false where the text has no window, where no language fits it better than even odds over all cells,
    or where the best posterior is below ``LEAST_CONFIDENCE``. Null or blank text: language null, confidence 0, not
    known. Null declared, suffix or host: no evidence, the level above counts. Ties go to the language that sorts
    first. Repeated rows are judged alike; no rows: no rows. All columns of ``rows`` are kept, but for those named like
    one of the three, which give way to it.
    """
    n = len(model.languages)
    names = {c: f"{prefix}{c}" for c in ("language", "confidence", "known")}
    if not n:
        return rows.withColumns(
            {
                names["language"]: F.lit(None).cast("string"),
                names["confidence"]: F.lit(0.0),
                names["known"]: F.lit(False),
            }
        )
    languages = F.array(*[F.lit(x) for x in model.languages])
    even = F.array(*[F.lit(1.0 / n)] * n)

    def evidence(df: DataFrame) -> DataFrame:
        return df.select(
            F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("_row"),
            model.likelihoods(text_or_empty(text)).alias("_scores"),
            F.array_position(languages, F.coalesce(_tag(declared), F.lit(""))).cast("int").alias("_said"),
            F.coalesce(F.lower(suffix), F.lit("")).alias("_suffix"),
            F.coalesce(F.lower(host), F.lit("")).alias("_host"),
        ).withColumns(
            {
                "_ll": F.slice("_scores", 1, n),
                "_windows": F.element_at("_scores", -1),
            }
        )

    seen = evidence(in_small_batches(rows))
    guess = F.array_position("_ll", F.array_max("_ll")).cast("int")
    # One row for each host, suffix, guess and declaration, written once; all that follows works on these counts.
    told = saved(
        seen.where(F.col("_windows") > 0)
        .groupBy("_suffix", "_host", guess.alias("_guess"), "_said")
        .agg(F.count(F.lit(1)).alias("_n"))
    )

    sums = [F.sum(F.when(F.col("_guess") == i + 1, F.col("_n")).otherwise(0)).cast("double") for i in range(n)]
    shape = (F.array(*sums).alias("_c"), F.sum("_n").cast("double").alias("_t"))

    def level(*keys: str) -> DataFrame:
        return told.groupBy(*keys).agg(*shape)

    agree = F.sum(F.when(F.col("_said") == F.col("_guess"), F.col("_n")).otherwise(0))
    said = F.sum(F.when(F.col("_said") > 0, F.col("_n")).otherwise(0))
    whole = told.agg(*shape, ((agree + 1) / (said + 2)).alias("_agree")).first()
    total = whole["_t"] or 0.0
    share = [((c or 0.0) + PRIOR_WEIGHT / n) / (total + PRIOR_WEIGHT) for c in (whole["_c"] or [0.0] * n)]
    share = F.array(*[F.lit(s) for s in share])
    trust = min(max(float(whole["_agree"] or 0.5), 1.0 / n), 0.98)
    suffixes = level("_suffix").select("_suffix", _prior(F.col("_c"), F.col("_t"), share).alias("_above"))
    hosts = (
        level("_suffix", "_host")
        .join(suffixes, "_suffix")
        .select("_suffix", "_host", _prior(F.col("_c"), F.col("_t"), F.col("_above")).alias("_prior"))
    )
    joined = seen.join(hosts, ["_suffix", "_host"], "left")
    weight = F.least(F.col("_windows"), F.lit(EVIDENCE))

    def log_posterior(i: int) -> Column:
        declares = F.when(F.col("_said") == 0, 0.0).otherwise(
            F.when(F.col("_said") == i + 1, F.lit(float(np.log(trust)))).otherwise(
                F.lit(float(np.log((1 - trust) / max(1, n - 1))))
            )
        )
        return weight * F.col("_ll")[i] + declares + F.log(F.coalesce(F.col("_prior"), share, even)[i])

    posterior = joined.withColumn("_log", F.array(*[log_posterior(i) for i in range(n)]))
    top = F.array_max("_log")
    confidence = 1 / F.aggregate("_log", F.lit(0.0), lambda s, x: s + F.exp(x - top))
    some = F.col("_windows") > 0
    best = F.array_position("_log", top).cast("int")
    fits = F.array_max("_ll") > F.lit(-float(np.log(CELLS)))
    return posterior.select(
        *[F.col(f"_row.`{c}`").alias(c) for c in rows.columns if c not in names.values()],
        F.when(some, languages[best - 1]).alias(names["language"]),
        F.when(some, confidence).otherwise(0.0).alias(names["confidence"]),
        (some & fits & (confidence >= LEAST_CONFIDENCE)).alias(names["known"]),
    )


def of_documents(docs: DataFrame, model: TextModel, prefix: str = "") -> DataFrame:
    """Documents carry no markup or address: ``lang`` is what is declared and ``source`` stands for the host."""
    return identify(docs, model, F.col("text"), F.col("lang"), F.lit(None).cast("string"), F.col("source"), prefix)


def of_pages(pages: DataFrame, model: TextModel, prefix: str = "") -> DataFrame:
    """Pages declare a language in their markup and have an address with host and suffix."""
    html = text_or_empty("html")
    body = F.regexp_replace(html, r"(?is)<(script|style|head|nav)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>|&[#\w]+;", " ")
    declared = F.regexp_extract(html, r"(?is)<html\b[^>]*?\slang\s*=\s*[\"']?([A-Za-z_-]+)", 1)
    host = F.regexp_extract(F.coalesce(F.col("url"), F.lit("")), r"(?i)^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1)
    return identify(pages, model, body, declared, F.substring_index(host, ".", -1), host, prefix)


def keep_known(docs: DataFrame, model: TextModel | None = None) -> DataFrame:
    """The documents whose language is known, with the columns they came with."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_document")
    judged = of_documents(docs.select(whole, "text", "lang", "source"), model or TextModel.fit(docs))
    return judged.where("known").select("_document.*")
