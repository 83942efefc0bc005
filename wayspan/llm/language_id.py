"""Language identification by Bayesian fusion of the text with what its surroundings say.

The posterior of a language is its text likelihood (hashed byte trigrams), times the likelihood
of the language that the markup declares, times that of the address suffix, times a prior of the
host. Declarations and suffixes are judged by how often they go with each language over all rows;
a host's prior is smoothed towards its domain's, and that towards the whole table's. All these
are grouped sums of the text posteriors, so they cover every row and combine before the shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayspan.llm import wordhash
from wayspan.llm.textops import store

TABLE = 1 << 16
CHUNK = 1 << 18  # bytes of text handled at once; a worker's arrays take some 30 times as much
TRAIN_ROWS = 8000  # labelled rows that the text model is fitted on, those with the smallest hash
DEPTH = 64  # a text counts as this many trigrams at most: neighbouring trigrams are not independent
STRENGTH = 20.0  # rows that a parent's prior weighs
MIN_SHARE = 0.3  # of letters among the characters that are not blank
MIN_POSTERIOR = 0.5
UNKNOWN = "und"

_FOLD = np.full(256, 32, np.uint32)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


@dataclass
class TextModel:
    languages: list[str]
    log_share: np.ndarray  # (TABLE, languages)


def _grams(raw: np.ndarray, limits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, whether it counts, letter flag) of the trigram around every byte."""
    folded = _FOLD[raw]
    padded = np.concatenate([[np.uint32(32)], folded, [np.uint32(32)]]).astype(np.uint32)
    left, right = padded[:-2].copy(), padded[2:].copy()
    left[limits[:-1][limits[:-1] < len(raw)]] = 32
    right[limits[1:][limits[1:] > 0] - 1] = 32
    code = (left << np.uint32(16)) | (folded << np.uint32(8)) | right
    letter = folded != 32
    return (code * np.uint32(2654435761)) >> np.uint32(16), letter, letter


def _row_sums(values: np.ndarray, limits: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    return total[limits[1:]] - total[limits[:-1]]


def train(labelled: DataFrame, id_col: str, text_col: str, label_col: str, rows: int = TRAIN_ROWS) -> TextModel:
    """Trigram shares of each label over at most ``rows`` labelled rows."""
    usable = labelled.filter(F.col(label_col).isNotNull() & F.col(text_col).isNotNull())
    # a hash draws somewhat more than needed first, so that only these texts are sorted
    share = min(1.0, (rows + 5 * rows**0.5) / max(1, usable.count()))
    drawn = F.shiftrightunsigned(F.xxhash64(id_col), 11) / F.lit(float(1 << 53)) <= share
    picked = usable.filter(drawn).orderBy(F.shiftrightunsigned(F.xxhash64(id_col), 11), id_col).limit(rows)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels = np.array(batch.column(0).to_pylist(), object)
            for start, end, raw, limits in wordhash.text_chunks(batch.column(1), CHUNK):
                gram, counts, _ = _grams(raw, limits)
                row = np.repeat(np.arange(start, end), np.diff(limits))
                for label in set(labels[start:end]):
                    own = gram[counts & (labels[row] == label)]
                    n = np.bincount(own, minlength=TABLE)
                    used = np.flatnonzero(n)
                    yield pa.record_batch([pa.array([label] * len(used), pa.string()), pa.array(used), pa.array(n[used])], names=["label", "gram", "n"])

    sums = picked.select(F.col(label_col).cast("string"), text_col).mapInArrow(read, "label string, gram long, n long").groupBy("label", "gram").agg(F.sum("n").alias("n"))
    found = sums.toPandas()  # at most TABLE rows a label
    languages = sorted(found["label"].unique())
    n = np.full((TABLE, len(languages)), 0.5)
    n[found["gram"], [languages.index(x) for x in found["label"]]] += found["n"]
    return TextModel(languages, np.log(n / n.sum(axis=0)).astype(np.float32))


def text_evidence(rows: DataFrame, model: TextModel, text_col: str = "text") -> DataFrame:
    """All columns with ``_evidence`` (log likelihood of every language, the best one at 0) and
    ``_letters`` (their share of the characters that are not blank; 0 without text)."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    spot = rows.columns.index(text_col)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for start, end, raw, limits in wordhash.text_chunks(batch.column(spot), CHUNK):
                gram, counts, letter = _grams(raw, limits)
                n = _row_sums(counts, limits)
                scale = np.minimum(n, DEPTH) / np.maximum(n, 1)
                each = [_row_sums(np.where(counts, m.log_share[gram, k], 0.0), limits) * scale for k in range(len(m.languages))]
                each = np.stack(each, 1) if each else np.zeros((end - start, 0))
                if each.shape[1]:
                    each -= each.max(axis=1, keepdims=True)
                share = _row_sums(letter, limits) / np.maximum(_row_sums(~wordhash.BLANK[raw], limits), 1)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, each.size + 1, max(1, each.shape[1]))[: end - start + 1] if each.shape[1] else np.zeros(end - start + 1, int), pa.int32()), pa.array(each.ravel()))
                yield pa.record_batch([c.slice(start, end - start) for c in batch.columns] + [lists, pa.array(share)], names=[*batch.schema.names, "_evidence", "_letters"])

    return rows.mapInArrow(read, f"{schema}, _evidence array<double>, _letters double")


def _posterior(logs: Column) -> Column:
    best = F.array_max(logs)
    raised = F.transform(logs, lambda x: F.exp(x - best))
    total = F.aggregate(raised, F.lit(0.0), lambda a, x: a + x)
    return F.transform(raised, lambda x: x / total)


def _added(n: int) -> list[Column]:
    return [F.coalesce(F.sum(F.get("share", F.lit(k))), F.lit(0.0)).alias(f"n{k}") for k in range(n)]


def _likelihoods(shares: DataFrame, key: str, n: int) -> DataFrame:
    """(key, log P(value | language) array): weighted counts with one row's weight for the unseen."""
    counted = shares.filter(F.col(key).isNotNull()).groupBy(key).agg(*_added(n))
    total = counted.agg(*[F.coalesce(F.sum(f"n{k}"), F.lit(0.0)) for k in range(n)], F.count("*")).first()
    logs = [F.log((F.col(f"n{k}") + 0.5) / F.lit(total[k] + 0.5 * (total[n] + 1))) for k in range(n)]
    return store(counted.select(key, F.array(*logs).alias(f"{key}_log")), key)


def _domain(host: Column) -> Column:
    """The last two labels of a host."""
    return F.substring_index(host, ".", -2)


def host_priors(shares: DataFrame, n: int, strength: float = STRENGTH) -> tuple[DataFrame, list[float]]:
    """(host, log prior array) and the prior of all rows together."""
    hosts = shares.filter("host is not null").groupBy("host").agg(*_added(n)).withColumn("domain", _domain(F.col("host")))
    whole = shares.agg(*_added(n)).first()
    size = sum(whole) or 1.0
    top = [(x + 1.0) / (size + n) for x in whole]
    domains = hosts.groupBy("domain").agg(*[F.sum(f"n{k}").alias(f"d{k}") for k in range(n)])
    rows = lambda p: sum((F.col(f"{p}{k}") for k in range(n)), F.lit(0.0))
    domains = domains.select("domain", *[((F.col(f"d{k}") + strength * top[k]) / (rows("d") + strength)).alias(f"p{k}") for k in range(n)])
    logs = [F.log((F.col(f"n{k}") + strength * F.col(f"p{k}")) / (rows("n") + strength)) for k in range(n)]
    return store(hosts.join(domains, "domain").select("host", F.array(*logs).alias("host_log")), "host"), top


def identify(rows: DataFrame, model: TextModel, text_col: str = "text", min_posterior: float = MIN_POSTERIOR, min_share: float = MIN_SHARE) -> DataFrame:
    """All columns of ``rows`` with language, posterior and accepted.

    Columns ``declared``, ``suffix`` and ``host`` are the further evidence; null in one of them
    says nothing. A row is rejected (language ``und``) if its text has no letters or too small a
    share of them, or if no language reaches ``min_posterior``; null text is empty. Ties go to
    the first language in alphabetical order. Columns named language, posterior or accepted are
    replaced.
    """
    n = len(model.languages)
    own = [c for c in rows.columns if c not in ("language", "posterior", "accepted")]
    scored = text_evidence(rows.select(*own), model, text_col)
    if not n:
        return scored.select(*own, F.lit(UNKNOWN).alias("language"), F.lit(0.0).alias("posterior"), F.lit(False).alias("accepted"))
    shares = scored.filter(F.col("_letters") >= min_share).select("declared", "suffix", "host", _posterior(F.col("_evidence")).alias("share"))
    shares = store(shares.groupBy("declared", "suffix", "host").agg(*_added(n)).select("declared", "suffix", "host", F.array(*[f"n{k}" for k in range(n)]).alias("share")), "evidence")
    hosts, top = host_priors(shares, n)
    joined = scored
    for key, table in (("declared", _likelihoods(shares, "declared", n)), ("suffix", _likelihoods(shares, "suffix", n)), ("host", hosts)):
        joined = joined.join(table, key, "left")
    nothing = F.array(*[F.lit(0.0)] * n)
    usual = F.array(*[F.log(F.lit(p)) for p in top])
    parts = [F.col("_evidence"), F.coalesce("declared_log", nothing), F.coalesce("suffix_log", nothing), F.coalesce("host_log", usual)]
    logs = F.array(*[sum((F.get(p, F.lit(k)) for p in parts[1:]), F.get(parts[0], F.lit(k))) for k in range(n)])
    judged = joined.withColumn("_p", _posterior(logs)).withColumn("_best", F.array_max("_p"))
    sure = (F.col("_letters") >= min_share) & (F.col("_best") >= min_posterior)
    name = F.get(F.array(*[F.lit(x) for x in model.languages]), (F.array_position("_p", F.col("_best")) - 1).cast("int"))
    return judged.select(*own, F.when(sure, name).otherwise(F.lit(UNKNOWN)).alias("language"), F.col("_best").alias("posterior"), sure.alias("accepted"))


def page_evidence(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """All columns with text, declared, suffix and host of web pages: the visible text, the language
    of the html tag, the top-level domain with a two-letter first folder, and the host."""
    html, url = F.coalesce(F.col(html_col), F.lit("")), F.col(url_col)
    bare = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>|&[a-zA-Z#0-9]+;", " ")
    host = F.nullif(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/:?#]+)", 1)), F.lit(""))
    folder = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+/([a-z]{2})(?:[/?#]|$)", 1)
    declared = F.nullif(F.lower(F.regexp_extract(html, r"(?is)<html\b[^>]*\blang\s*=\s*[\"']?([a-z]{2,3})", 1)), F.lit(""))
    return pages.withColumns({"text": bare, "declared": declared, "host": host, "suffix": F.concat_ws("/", F.substring_index(host, ".", -1), F.nullif(folder, F.lit("")))})
