"""Vectors of all magnitudes, vocabularies with other rules, and languages under disagreeing evidence."""

import json
import math
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from footfall.llm import language, vectors
from footfall.llm.common import ship_package
from footfall.llm.vocab import Vocabulary

VECTORS = "vec_id long, label int, embedding array<double>"


@pytest.fixture(autouse=True)
def shipped(spark):
    ship_package(spark)


# --- vectors --------------------------------------------------------------------------
def exact_links(rows, threshold=vectors.THRESHOLD):
    def near(a, b):
        a, b = [Fraction(x) for x in a], [Fraction(x) for x in b]
        dot = sum(x * y for x, y in zip(a, b, strict=True))
        return dot > 0 and dot * dot >= Fraction(threshold) ** 2 * sum(x * x for x in a) * sum(y * y for y in b)

    return {
        i: sum(i != j and near(v, w) for j, _, w in rows) for i, _, v in rows
    }


def test_links_at_all_magnitudes(spark):
    rng = np.random.default_rng(3)
    rows = []
    for base in rng.normal(size=(6, 3)):
        for scale in (1e-320, 1e-300, 1e-200, 1.0, 3.0, 1e200, 1e300):
            noise = rng.normal(size=3) * rng.choice([0.0, 0.2, 0.5])
            rows.append((len(rows), 1, [float(x) for x in (base + noise) * scale]))
    rows += [(100, 1, [5e-324, 0.0, 0.0]), (101, 1, [1e308, 0.0, 0.0]), (102, 1, [1e300, 1e-300, 0.0])]
    rows = [r for r in rows if any(r[2])]
    found = vectors.near_vectors(spark.createDataFrame(rows, VECTORS)).collect()
    assert {r.vec_id: r.n_links for r in found} == exact_links(rows)


# --- vocabularies ------------------------------------------------------------------------
def test_a_vocabulary_that_keeps_case_is_left_to_the_library(tmp_path):
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as source:
        rules = json.load(source)
    rules["normalizer"]["normalizers"] = rules["normalizer"]["normalizers"][:2]
    path = tmp_path / "kept_case.json"
    path.write_text(json.dumps(rules), encoding="utf-8")
    text = "Ab cD it's 12 up"
    want = Tokenizer.from_file(str(path)).encode(text, add_special_tokens=False).ids
    vocab = Vocabulary(str(path))
    assert np.frombuffer(vocab.encode([text])[0], "<u4").tolist() == want
    assert vocab.encode([text]) != Vocabulary(public_tokenizers.path("word_bpe_49k.json")).encode([text])


# --- languages ----------------------------------------------------------------------------
def fused(pages, model):
    """The fusion in plain Python."""
    k = len(model.languages)

    def softmax(x):
        raised = np.exp(x - np.max(x))
        return raised / raised.sum()

    each = []
    for page_id, url, html in pages:
        host = language.host_of(url or "")
        parts = host.split(".")
        ll = model.log_likelihoods(language.page_text(html or ""))
        each.append({
            "id": page_id, "host": host, "domain": ".".join(parts[-2:]),
            "suffix": parts[-1] if len(parts) > 1 else "",
            "declared": language.declared_language(html or ""), "ll": ll, "p": softmax(ll),
        })

    def sums(key):
        out = {}
        for e in each:
            out[e[key]] = out.get(e[key], np.zeros(k)) + e["p"]
        return out

    every = sum(e["p"] for e in each)
    general = (every + language._ALL_WEIGHT) / (every.sum() + k * language._ALL_WEIGHT)
    tables = {key: sums(key) for key in ("host", "domain", "suffix", "declared")}

    def lean(own, base, weight):
        return (np.maximum(own, 0) + weight * base) / (own.sum() + weight)

    def likelihood(key, value):
        if not value:
            return np.full(k, 1 / k)
        own = tables[key][value]
        share = own.sum() / max(every.sum(), 1.0)
        weight = language._EVIDENCE_WEIGHT
        return (own + weight * share) / (every + weight)

    out = {}
    for e in each:
        base = lean(tables["domain"][e["domain"]], general, language._DOMAIN_WEIGHT)
        prior = lean(tables["host"][e["host"]] - e["p"], base, language._HOST_WEIGHT)
        if not e["host"]:
            prior = np.full(k, 1 / k)
        score = e["ll"].copy()
        for part in (prior, likelihood("declared", e["declared"]), likelihood("suffix", e["suffix"])):
            score += np.log(np.maximum(part, 1e-12))
        post = softmax(score)
        out[e["id"]] = (model.languages[int(np.argmax(post))], float(post.max()))
    return out


def test_fusion_equals_plain_python_where_evidence_disagrees(spark):
    words = {"de": "der und nicht ist das", "en": "the and not is that", "fr": "le et ne est que"}
    docs = [(i * 3 + j, text * 4, lang) for j, (lang, text) in enumerate(words.items()) for i in range(5)]
    docs.append((99, "ez nagyon ritka nyelv", "hu"))
    model = language.fit_text_model(spark.createDataFrame(docs, "doc_id long, text string, lang string"))
    assert model.languages == ["de", "en", "fr", "hu"], "a language of one text has a model"
    pages = []
    for host, lang, n in (("a.x.de", "de", 12), ("b.x.fr", "fr", 9), ("c.y.com", "en", 14), (None, "de", 20)):
        for i in range(n):
            markup = lang if i % 3 else "en"
            pages.append((len(pages), f"http://{host}/{i}" if host else None,
                          f'<html lang="{markup}"><body>{words[lang]}</body>'))
    pages += [
        (200, "http://a.x.de/1", '<html lang="fr">the'), (201, "http://b.x.fr/2", '<html lang="de">is'),
        (202, None, None), (203, "http://c.y.com", ""), (204, "http://new.x.de", '<html lang="en">le'),
        (205, "http://q.zz", '<html lang="xx">e'), (206, None, '<html lang="en">d'),
    ]
    rows = language.languages_of(
        spark.createDataFrame(pages, "page_id long, url string, html string"), model
    ).collect()
    want = fused(pages, model)
    assert len(rows) == len(pages)
    for row in rows:
        lang, confidence = want[row.page_id]
        assert math.isclose(row.confidence, confidence, abs_tol=2e-6), row
        assert row.lang == lang or confidence < 0.51
    told = {r.page_id: r for r in rows}
    assert any(told[i].lang != told[i].text_lang for i in (200, 201, 204, 206)), "the fusion decides some"
    assert told[202].confidence < 0.6, "a page without anything is not sure"


def test_training_texts_are_bounded_per_language(spark):
    docs = [(i, "aa bb cc", "en") for i in range(50)] + [(50 + i, "dd ee", "fr") for i in range(3)]
    docs += [(7, None, "en"), (None, "ffff", "nl"), (8, "x", None)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    small = language.fit_text_model(df, most_rows=2)
    assert small.languages == ["en", "fr", "nl"]
    assert language.fit_text_model(df.limit(0)).languages == []
