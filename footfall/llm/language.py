"""Language of web pages by Bayesian fusion of four kinds of evidence.

The likelihood of the text under trigram models, of the declared markup language
and of the address suffix, and a prior of the host that leans on its domain and on
all pages. Every table of evidence is a grouped aggregation over all pages.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.functions.groups import first_rows
from footfall.llm.common import stage

#: Labelled texts of each language that its trigram model is fitted on at most, chosen by a
#: hash of the id. Every language that labels a text has a model.
MAX_TRAINING_ROWS = 1_000

_CELLS = 1 << 14  # hashed trigrams
_TEMPER = 1 / 3  # neighbouring trigrams share two of three signs
_HOST_WEIGHT, _DOMAIN_WEIGHT, _ALL_WEIGHT = 4.0, 8.0, 1.0
_EVIDENCE_WEIGHT = 2.0  # pseudo-pages of an evidence's general distribution

_HIDDEN = re.compile(r"(?is)<(script|style|noscript|template)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>")
_DECLARED = re.compile(r"""(?is)<html\b[^>]*?\b(?:xml:)?lang\s*=\s*["']?\s*([a-z]{2,8})""")


def page_text(source: str) -> str:
    return html.unescape(_HIDDEN.sub(" ", source))


def declared_language(source: str) -> str:
    """The primary part of the language that the markup declares; empty if none."""
    found = _DECLARED.search(source)
    return found[1].lower() if found else ""


def host_of(url: str) -> str:
    try:
        return (urlsplit(url if "//" in url else f"//{url}").hostname or "").rstrip(".")
    except ValueError:
        return ""


def trigram_cells(text: str) -> np.ndarray:
    signs = np.frombuffer(" ".join(text.lower().split()).encode("utf-32-le", "replace"), "<u4")
    if len(signs) < 3:
        return np.zeros(0, np.int64)
    signs = signs.astype(np.uint64)
    with np.errstate(over="ignore"):
        mixed = (
            signs[:-2] * np.uint64(0x9E3779B97F4A7C15)
            ^ signs[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F)
            ^ signs[2:] * np.uint64(0x165667B19E3779F9)
        )
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (mixed >> np.uint64(64 - 14)).astype(np.int64)


class TextModel:
    """Log-probability of every hashed trigram by language."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages = languages
        smoothed = counts + 0.5
        self.table = np.log(smoothed / smoothed.sum(axis=1, keepdims=True)).astype(np.float32)

    def log_likelihoods(self, text: str) -> np.ndarray:
        return self.table[:, trigram_cells(text)].sum(axis=1, dtype=np.float64) * _TEMPER


def fit_text_model(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    most_rows: int = MAX_TRAINING_ROWS,
) -> TextModel:
    """Trigram models from at most ``most_rows`` whole texts of each language that is given."""
    known = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    ids = known.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang")).distinct()
    chosen = stage(
        first_rows(ids, ["lang"], [F.xxhash64("id"), F.col("id")], most_rows), "training_ids"
    ).select(F.col("id").alias("k"), F.col("lang").alias("l"))
    texts = known.select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")
    )
    texts = texts.join(chosen, F.col("id").eqNullSafe(F.col("k")) & (F.col("lang") == F.col("l")), "left_semi")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, lang in zip(
                batch.column("text").to_pylist(), batch.column("lang").to_pylist(), strict=True
            ):
                sums.setdefault(lang, np.zeros(_CELLS, np.int64))
                sums[lang] += np.bincount(trigram_cells(text), minlength=_CELLS)
        langs = [lang for lang in sums for _ in range(_CELLS)]
        cells = np.tile(np.arange(_CELLS), len(sums))
        values = np.concatenate([*sums.values(), np.zeros(0, np.int64)])
        yield pa.RecordBatch.from_arrays(
            [pa.array(langs, pa.string()), pa.array(cells, pa.int64()), pa.array(values, pa.int64())],
            ["lang", "cell", "n"],
        )

    counts = stage(
        texts.select("text", "lang").mapInArrow(count, "lang string, cell long, n long")
        .filter("n > 0").groupBy("lang", "cell").agg(F.sum("n").alias("n")),
        "trigrams",
    )
    rows = counts.groupBy("lang").agg(
        F.collect_list("cell").alias("cells"), F.collect_list("n").alias("ns")
    )
    found = {r.lang: (r.cells, r.ns) for r in rows.collect()}  # a row of _CELLS numbers per language
    languages = sorted(found)
    sums = np.zeros((len(languages), _CELLS))
    for place, lang in enumerate(languages):
        cells, ns = found[lang]
        sums[place, cells] = ns
    return TextModel(languages, sums)


def page_evidence(pages: DataFrame, model: TextModel) -> DataFrame:
    """page_id, host, domain, suffix, declared, ll: what each page says by itself."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names: dict[str, list[str]] = {"host": [], "domain": [], "suffix": [], "declared": []}
            found = []
            for url, source in zip(
                batch.column("url").to_pylist(), batch.column("html").to_pylist(), strict=True
            ):
                host = host_of(url or "")
                parts = host.split(".")
                names["host"].append(host)
                names["domain"].append(".".join(parts[-2:]))
                names["suffix"].append(parts[-1] if len(parts) > 1 else "")
                names["declared"].append(declared_language(source or ""))
                found.append(model.log_likelihoods(page_text(source or "")))
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), *[pa.array(v, pa.string()) for v in names.values()],
                 pa.array(found, pa.list_(pa.float64()))],
                ["page_id", *names, "ll"],
            )

    kind = dict(pages.dtypes)["page_id"]
    return pages.mapInArrow(
        read,
        f"page_id {kind}, host string, domain string, suffix string, declared string, ll array<double>",
    )


def _softmax(scores: Column) -> Column:
    top = F.array_max(scores)
    raised = F.transform(scores, lambda x: F.exp(x - top))
    total = F.aggregate(raised, F.lit(0.0), lambda s, x: s + x)
    return F.transform(raised, lambda x: x / total)


def _log(values: Column) -> Column:
    return F.transform(values, lambda x: F.log(F.greatest(x, F.lit(1e-12))))


def languages_of(
    pages: DataFrame,
    model: TextModel,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
) -> DataFrame:
    """One row per row of ``pages``: page_id, lang, confidence, text_lang, declared, host.

    A page's text alone gives it soft counts per language. Their sums by host, by
    domain and over all pages make the prior, each level leaning on the next; a
    page's own count is taken out of its host first. Sums by declared language and
    by suffix give P(declared | language) and P(suffix | language).

    * null or empty html, null url: that evidence is even, the rest decides.
    * repeated rows: each counts and has its own output row. Ties: first language
      in alphabetical order. Empty table: no rows. Other columns are ignored.
    * no labelled text at all: lang is null, confidence 0.
    """
    langs = model.languages
    rows = pages.select(
        F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html")
    )
    if not langs:
        return rows.select(
            "page_id", F.lit(None).cast("string").alias("lang"), F.lit(0.0).alias("confidence"),
            F.lit(None).cast("string").alias("text_lang"), F.lit("").alias("declared"),
            F.lit("").alias("host"),
        )
    each = stage(page_evidence(rows, model).withColumn("p", _softmax(F.col("ll"))), "evidence")
    k = len(langs)

    def sums(frame: DataFrame, *keys: str) -> DataFrame:
        """Soft counts per key as an array; combined inside map tasks."""
        parts = frame.groupBy(*keys).agg(*[F.sum(F.col("p")[i]).alias(f"s{i}") for i in range(k)])
        return parts.select(*keys, F.array(*[f"s{i}" for i in range(k)]).alias("p"))

    by_host = stage(sums(each, "host", "domain"), "hosts")
    by_domain = stage(sums(by_host, "domain"), "domains")
    everything = [float(x) for x in (sums(by_domain.withColumn("a", F.lit(1)), "a").first() or {"p": [0.0] * k})["p"]]
    total = sum(everything)
    general = [(x + _ALL_WEIGHT) / (total + k * _ALL_WEIGHT) for x in everything]
    general_col = F.array(*[F.lit(x) for x in general])

    def lean(own: Column, base: Column, weight: float) -> Column:
        n = F.aggregate(own, F.lit(0.0), lambda s, x: s + x)
        return F.zip_with(own, base, lambda c, b: (F.greatest(c, F.lit(0.0)) + weight * b) / (n + weight))

    def likelihood(key: str) -> DataFrame:
        """P(key | language), smoothed by how common the key is."""
        table = sums(each, key)
        share = F.aggregate("p", F.lit(0.0), lambda s, x: s + x) / max(total, 1.0)
        per = F.array(*[F.lit(x + _EVIDENCE_WEIGHT) for x in everything])
        value = F.zip_with("p", per, lambda c, n: (c + _EVIDENCE_WEIGHT * share) / n)
        return stage(table.select(F.col(key).alias(f"{key}_k"), value.alias(f"{key}_l")), key)

    domains = by_domain.select(
        F.col("domain").alias("domain_k"), lean(F.col("p"), general_col, _DOMAIN_WEIGHT).alias("base")
    )
    priors = stage(
        by_host.join(domains, F.col("domain") == F.col("domain_k")).select(
            F.col("host").alias("host_k"), F.col("p").alias("host_p"), "base"
        ),
        "host_priors",
    )
    joined = each.join(priors, F.col("host") == F.col("host_k"))
    for key in ("declared", "suffix"):
        joined = joined.join(likelihood(key), F.col(key) == F.col(f"{key}_k"))
    others = F.zip_with("host_p", "p", lambda c, x: c - x)
    even = F.array(*[F.lit(1.0 / k)] * k)
    prior = F.when(F.col("host") == "", even).otherwise(lean(others, F.col("base"), _HOST_WEIGHT))
    told = F.when(F.col("declared") == "", even).otherwise(F.col("declared_l"))
    ended = F.when(F.col("suffix") == "", even).otherwise(F.col("suffix_l"))
    total_score = F.col("ll")
    for part in (prior, told, ended):
        total_score = F.zip_with(total_score, _log(part), lambda a, b: a + b)
    fused = joined.withColumn("post", _softmax(total_score))
    names = F.array(*[F.lit(x) for x in langs])

    def best(values: Column) -> Column:
        return names[F.array_position(values, F.array_max(values)).cast("int") - 1]

    return fused.select(
        "page_id",
        best(F.col("post")).alias("lang"),
        F.round(F.array_max("post"), 6).alias("confidence"),
        best(F.col("p")).alias("text_lang"),
        "declared",
        "host",
    )
