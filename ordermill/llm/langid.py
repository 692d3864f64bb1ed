"""Language identification by Bayesian evidence fusion.

A text's likelihood under each language (byte trigrams, naive Bayes) is
combined with the language declared in markup, the address suffix and a prior
of the host. What each declaration, suffix, registered domain and host says is
counted over all rows, as the sum of the text posteriors, by grouped
aggregation; a host's prior is smoothed by its domain's and that by the whole
table's. Only the trigram tables are fitted on a sample, of about
``TRAIN_ROWS`` labelled rows.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import keep_rows, materialise, row_key, text_of

LANGUAGES = ("de", "en", "es", "fr")
TRAIN_ROWS = 20_000       # about so many labelled rows fit the trigram tables
BUCKETS = 1 << 14
EVIDENCE = 40.0           # a text counts as this many independent trigrams at most
PRIOR_ROWS = 10.0         # weight of a parent's distribution in its children's
ALPHA = 1.0
MIN_POSTERIOR = 0.5
SALTS = 16
_CHUNK = 1 << 20
_UNIT = 1_000_000         # posteriors are summed as whole millionths, so sums are exact
FINGERPRINT = 0x9E3779B1


def trigram_counts(text: str) -> np.ndarray:
    """Counts of hashed byte trigrams of a lower-cased text, blank at both ends."""
    raw = np.frombuffer(f" {text.lower()} ".encode(), np.uint8)
    counts = np.zeros(BUCKETS, np.int64)
    for k in range(0, len(raw) - 2, _CHUNK):
        b = raw[k:k + _CHUNK + 2].astype(np.uint32)
        key = (b[:-2] | b[1:-1] << np.uint32(8) | b[2:] << np.uint32(16)) * np.uint32(FINGERPRINT)
        counts += np.bincount(key >> np.uint32(18), minlength=BUCKETS)
    return counts


def train(labelled: DataFrame, label: str, languages: tuple[str, ...] = LANGUAGES,
          train_rows: int = TRAIN_ROWS) -> np.ndarray:
    """Log-probabilities (bucket, language) from about ``train_rows`` rows of
    ``labelled`` (doc_id, text, label), taken by a hash of doc_id. What comes
    to the driver is bounded by buckets times languages."""
    rows = labelled.where(F.col(label).isin(*languages))
    share = min(1.0, train_rows / max(1, rows.count()))
    rows = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 31)) < int(share * (1 << 31)))

    def count(batches):
        total = {lang: np.zeros(BUCKETS, np.int64) for lang in languages}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                total[lang] += trigram_counts(text)
        for k, lang in enumerate(languages):
            used = np.flatnonzero(total[lang])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(used), k)), pa.array(used), pa.array(total[lang][used])], names=["lang", "bucket", "n"])

    counts = (rows.select(F.col(label).alias("lang"), text_of("text").alias("text"))
              .mapInArrow(count, "lang long, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")))
    table = np.full((BUCKETS, len(languages)), 0.1)
    for lang, bucket, n in counts.collect():
        table[bucket, lang] += n
    return np.log(table / table.sum(axis=0))


def _score(model: np.ndarray, languages: tuple[str, ...]):
    floor = np.log(1 / BUCKETS)

    def run(batches):
        for batch in batches:
            out = []
            for text in batch.column(4).to_pylist():
                counts = trigram_counts(text)
                used = np.flatnonzero(counts)
                n = counts.sum()
                mean = (counts[used] @ model[used]) / n if n else np.zeros(len(languages))
                known = any(c.isalpha() for c in text) and bool(mean.max() >= floor)
                scaled = mean * min(float(n), EVIDENCE)
                post = np.exp(scaled - scaled.max())
                out.append((known, (scaled - scaled.max()).tolist(), np.rint(known * post / post.sum() * _UNIT).astype(np.int64).tolist()))
            known, scaled, post = map(list, zip(*out)) if out else ([], [], [])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array(known, pa.bool_()), pa.array(scaled, pa.list_(pa.float64())),
                 pa.array(post, pa.list_(pa.int64()))],
                names=["doc_id", "row_key", "declared", "host", "known", "loglik", "post"])
    return run


_SCORED = ("doc_id long, row_key long, declared string, host string, known boolean, loglik array<double>, post array<bigint>")


def declared_in(html: Column) -> Column:
    """The primary subtag of the language that the html element declares."""
    found = F.regexp_extract(html, r"(?i)<html\b[^<>]*?\blang\s*=\s*[\"']?\s*([A-Za-z]{2,8})", 1)
    return F.lower(F.nullif(found, F.lit("")))


def host_of(url: Column) -> Column:
    return F.lower(F.nullif(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1), F.lit("")))


_OPEN = re.compile(r"<(?:(script)\b|(style)\b|!--)", re.A | re.I)
_CLOSE = {kind: re.compile(pattern, re.A | re.I) for kind, pattern in
          (("script", r"</script\s*>"), ("style", r"</style\s*>"), ("comment", "-->"))}
_ENTITY = re.compile(r"&#?\w+;", re.A)


def without_markup(html: str) -> str:
    """A page's text: scripts, styles, comments, tags and entities become
    blanks. What is never closed stays. One pass each, however broken."""
    out, at, closed = [], 0, dict.fromkeys(_CLOSE, True)
    for found in _OPEN.finditer(html):
        kind = (found[1] or found[2] or "comment").lower()
        if found.start() < at or not closed[kind]:
            continue
        end = _CLOSE[kind].search(html, found.end())
        closed[kind] = end is not None                    # not closed here: nor from any later place
        if end:
            out += [html[at:found.start()], " "]
            at = end.end()
    html = "".join([*out, html[at:]])
    out, at = [], 0
    while (start := html.find("<", at)) >= 0 and (end := html.find(">", start)) >= 0:
        out += [html[at:start], " "]
        at = end + 1
    return _ENTITY.sub(" ", "".join([*out, html[at:]]))


def visible_text(html: Column) -> Column:
    return F.udf(lambda h: None if h is None else without_markup(h), "string", useArrow=True)(html)


def _sums(rows: DataFrame, *keys: str, n: int) -> DataFrame:
    """Summed posteriors of each key, as an array."""
    return rows.groupBy(*keys).agg(F.array(*[F.sum(F.col("post")[i]) / _UNIT for i in range(n)]).alias("sums"))


def _smooth(sums: Column, parent: Column, own: Column | None = None) -> Column:
    """A distribution from counts and a parent distribution; ``own`` counts
    are taken out first, so that no row is its own evidence."""
    if own is not None:
        sums = F.zip_with(sums, own, lambda a, b: F.greatest(a - b / _UNIT, F.lit(0.0)))
    total = F.aggregate(sums, F.lit(0.0), lambda a, b: a + b) + PRIOR_ROWS
    return F.zip_with(sums, parent, lambda a, p: (a + PRIOR_ROWS * p) / total)


def identify(rows: DataFrame, model: np.ndarray, languages: tuple[str, ...] = LANGUAGES,
             accept: tuple[str, ...] | None = None) -> DataFrame:
    """A row per row of ``rows`` (doc_id, row_key, text, declared, host; all
    may be null): doc_id, row_key, lang, posterior, text_lang, kept.

    A row is rejected (``kept`` false) if its text has no letter or is less
    likely under every language than uniform noise, if no language reaches a
    posterior of ``MIN_POSTERIOR``, or if its language is not accepted. A
    missing declaration, host or suffix is no evidence; ties take the first
    language by name. Hosts are joined over salted copies, as one may hold a
    third of the rows.
    """
    n = len(languages)
    plain = rows.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("row_key").cast("long").alias("row_key"),
                        F.col("declared").cast("string").alias("declared"), F.col("host").cast("string").alias("host"),
                        text_of("text").alias("text"))
    scored = materialise(plain.mapInArrow(_score(model, languages), _SCORED), "langid_scores")
    labels = F.split("host", r"\.")
    dotted = (F.size(labels) > 1) & ~F.col("host").rlike(r"^[0-9.]+$")
    scored = scored.withColumn("domain", F.when(dotted, F.array_join(F.slice(labels, -2, 2), ".")).otherwise(F.col("host")))
    scored = scored.withColumn("suffix", F.when(dotted, F.element_at(labels, -1)))
    even = F.array(*[F.lit(1.0 / n)] * n)
    # rows that are not known count nothing
    whole = _sums(scored, n=n).select(
        _smooth(F.transform("sums", lambda x: F.coalesce(x, F.lit(0.0))), even)).scalar()
    hosts = _sums(scored.where(F.col("host").isNotNull()), "domain", "host", n=n)
    domains = _sums(scored.where(F.col("host").isNotNull()), "domain", n=n).withColumn("whole", whole).select(
        "domain", _smooth(F.col("sums"), F.col("whole")).alias("domain_prior"))
    hosts = hosts.join(domains, "domain").select(
        "host", F.col("sums").alias("host_sums"), "domain_prior",
        F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))

    def likelihood(key: str) -> DataFrame:
        """log P(key | language), smoothed, of each value of ``key``."""
        sums = _sums(scored.where(F.col(key).isNotNull()), key, n=n)
        total = sums.select(F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("i"), "sums").groupBy("i").agg(
            F.sum(F.col("sums")[F.col("i")]).alias("t"), F.count(F.lit(1)).alias("v"))
        total = total.agg(F.transform(F.array_sort(F.collect_list(F.struct("i", (F.col("t") + ALPHA * F.col("v")).alias("t")))),
                                      lambda s: s["t"])).scalar()
        return sums.withColumn("totals", total).select(
            key, F.zip_with("sums", "totals", lambda a, t: F.log((a + ALPHA) / t)).alias(f"log_{key}"))

    zero = F.array(*[F.lit(0.0)] * n)
    joined = (scored.withColumn("whole", whole)
              .withColumn("salt", F.pmod(F.xxhash64("doc_id", "row_key"), F.lit(SALTS)).cast("int"))
              .join(hosts, ["host", "salt"], "left").join(likelihood("declared"), "declared", "left")
              .join(likelihood("suffix"), "suffix", "left"))
    prior = F.when(F.col("host_sums").isNotNull(), _smooth(F.col("host_sums"), F.col("domain_prior"), F.col("post"))).otherwise(F.col("whole"))
    joined = joined.withColumn("fused", F.zip_with(
        F.zip_with("loglik", F.transform(prior, lambda p: F.log(p)), lambda a, b: a + b),
        F.zip_with(F.coalesce("log_declared", zero), F.coalesce("log_suffix", zero), lambda a, b: a + b), lambda a, b: a + b))
    top = F.array_max("fused")
    posterior = 1 / F.aggregate("fused", F.lit(0.0), lambda s, x: s + F.exp(x - top))
    names = F.array(*[F.lit(x) for x in languages])
    lang = names[(F.array_position("fused", top) - 1).cast("int")]
    text_lang = names[(F.array_position("loglik", F.array_max("loglik")) - 1).cast("int")]
    out = joined.select("doc_id", "row_key", lang.alias("lang"), posterior.alias("posterior"), text_lang.alias("text_lang"), "known")
    kept = F.col("known") & (F.col("posterior") >= MIN_POSTERIOR) & F.col("lang").isin(*(accept or languages))
    return out.withColumn("kept", kept).drop("known")


def document_evidence(docs: DataFrame) -> DataFrame:
    """Documents as evidence: the source is the host; nothing is declared."""
    none = F.lit(None).cast("string")
    return docs.select("doc_id", row_key("doc_id", "text", "source").alias("row_key"), "text", none.alias("declared"),
                       F.col("source").alias("host"))


def page_evidence(pages: DataFrame) -> DataFrame:
    """Pages as evidence; page ``p`` has doc_id ``-1 - p``."""
    html = text_of("html")
    return pages.select((F.lit(-1) - F.col("page_id")).alias("doc_id"), row_key("page_id", "url", "html").alias("row_key"),
                        visible_text(html).alias("text"), declared_in(html).alias("declared"), host_of(F.col("url")).alias("host"))


def accepted_rows(docs: DataFrame, model: np.ndarray, **options) -> DataFrame:
    """The rows of ``docs`` that :func:`identify` keeps, in its own layout."""
    found = identify(document_evidence(docs), model, **options).where("kept")
    return keep_rows(docs, found, ("doc_id", "text", "source"))
