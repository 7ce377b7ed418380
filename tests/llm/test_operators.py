"""Each operator on small frames: nulls, ties, repeated rows, empty tables, clashing columns."""

import hashlib
import math
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from footfall.llm import (
    bpe, chat, exact_dedup, language, mixing, near_dedup, separator_scan, token_index, toxicity,
    vectors, vocab,
)
from footfall.llm.common import BATCH_ROWS, ship_package
from footfall.llm.vocab import vocabulary

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
DOCS = "doc_id long, text string, source string, h int, n int, component string"


@pytest.fixture(autouse=True)
def shipped(spark):
    ship_package(spark)


def docs(spark, *texts, ids=None, sources=None):
    ids = ids or range(len(texts))
    sources = sources or ["s"] * len(texts)
    rows = [(i, t, s, 1, 2, "x") for i, t, s in zip(ids, texts, sources, strict=True)]
    return spark.createDataFrame(rows, DOCS)


def prose(seed, n=120):
    rng = random.Random(seed)
    return ["".join(rng.choices("abcdefghij", k=4)) for _ in range(n)]


# --- exact copies -------------------------------------------------------------------
@pytest.mark.parametrize("content_hash", [exact_dedup.md5_128, lambda c: F.lit(b"same")])
def test_exact_copies_and_colliding_hashes(spark, content_hash):
    df = docs(spark, "a b", "ab", " a b ", None, "", "c", "\u00a0c", "c", ids=[5, 1, 3, 7, 6, 9, 8, 9])
    rows = exact_dedup.exact_duplicates(df, content_hash=content_hash).collect()
    got = sorted((r.doc_id, r.keep_id, r.group_size, r.kept) for r in rows)
    assert got == [(1, 3, 3, False), (3, 3, 3, True), (5, 3, 3, False), (6, 6, 2, True),
                   (7, 6, 2, False), (8, 8, 1, True), (9, 9, 2, True), (9, 9, 2, True)]
    digest = {r.doc_id: r.text_sha256 for r in rows}
    assert digest[5] == hashlib.sha256(b"ab").hexdigest()
    assert exact_dedup.exact_duplicates(docs(spark)).count() == 0


# --- mixing -----------------------------------------------------------------------------
def test_mix_meets_targets(spark):
    texts = ["w " * (i % 7 + 1) for i in range(60)] + [None, ""]
    df = docs(spark, *texts, sources=[["a", "b", None][i % 3] for i in range(62)])
    rows = mixing.mix(df).collect()
    for source in ("a", "b", None):
        mine = [r for r in rows if r.source == source]
        assert abs(sum(r.taken for r in mine) - mine[0].target) < 1
        assert all(0 <= r.taken <= 2 * r.size for r in mine)
        assert mine[0].target <= 2 * mine[0].source_size
    total = sum(r.size for r in rows)
    assert sum(r.taken for r in rows) == pytest.approx(1.5 * total, abs=3)
    again = mixing.mix(df.repartition(7)).collect()
    assert sorted((r.doc_id, r.taken) for r in again) == sorted((r.doc_id, r.taken) for r in rows)
    assert mixing.mix(docs(spark)).count() == 0
    assert [r.taken for r in mixing.mix(docs(spark, None, "")).collect()] == [0, 0]


# --- chat -----------------------------------------------------------------------------------
TURNS = "conv_id long, turn long, role string, text string, window int, pos int"


def test_chat_windows_read_back(spark):
    rng = random.Random(3)
    odd = ["<|turn|>x\n", "<\\|end|>", "[INST] <<SYS>> \\[/INST]", "<s>\\</s>", None, "", "plain " * 90]
    rows = [(c, t, ["system", "user", "assistant", None, "a\\n\n<|turn|>"][rng.randrange(5)],
             rng.choice(odd), 0, 0) for c in range(12) for t in range(rng.randrange(1, 14))]
    df = spark.createDataFrame(rows, TURNS)
    windows = chat.chat_windows(df, budget=200, history=40)
    assert all(r.over_budget == (r.n_tokens > 200) for r in windows.collect())
    got = {r.conv_id: r for r in chat.conversation_digests(windows).collect()}
    for conv in range(12):
        turns = [(r[2] or "", r[3] or "") for r in rows if r[0] == conv]
        said = "".join(f"{role}\n{text}\n" for role, text in turns)
        learnt = "".join(text for role, text in turns if role == "assistant")
        assert got[conv].n_turns == len(turns)
        assert got[conv].turns_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert got[conv].loss_sha256 == hashlib.sha256(learnt.encode()).hexdigest()
        assert got[conv].loss_chars == len(learnt)
    assert chat.chat_windows(spark.createDataFrame([], TURNS)).count() == 0


# --- tokens ----------------------------------------------------------------------------------
TEXTS = [None, "", "It's 12³ naïve İx ΑΣ", "a\x1cb\x85c\u00a0d", "<|endoftext|>x<|ENDOFTEXT|>",
         "漢字，漢" * 40, "x" * 300 + "ab" * 250, "the " * 50, "!!'s??'re" * 30, "e\u0301 \u0301"]


def library_ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("long_chars", [40, 1 << 16])
def test_bpe_equals_the_library(spark, long_chars):
    rows = bpe.encode(docs(spark, *TEXTS), PATH, bpe.AsTexts(), long_chars=long_chars).collect()
    for r in rows:
        want = library_ids(TEXTS[r.doc_id])
        assert r.ids == want
        assert r.decoded == LIBRARY.decode(want, skip_special_tokens=False)
    assert bpe.encode(docs(spark), PATH).count() == 0


def test_words_that_texts_repeat_are_tokenized_once(monkeypatch):
    monkeypatch.setattr(vocab, "_CACHED_WORDS", 100)
    words = vocab.Vocabulary(PATH)
    asked, tokenize = [], words._tokenize
    words._tokenize = lambda word: asked.append(word) or tokenize(word)
    texts = [f"often, Often often! zqx{i:03d}".replace("0", "y") for i in range(400)]
    expected = [words.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    found = [np.frombuffer(b, "<u4").tolist() for b in words.encode(texts)]
    assert found == expected
    assert asked.count("often") == 1
    assert len(words._chunks) + len(words._chunks._older) <= 100


def test_joined_halves_equal_the_whole_word():
    vocab, rng = vocabulary(PATH), random.Random(5)
    parts = ["the", "ing", "tion", "er", "ou", "an", "st", "q", "zz", "é", "ß"]
    for _ in range(300):
        word = vocab.spelt("".join(rng.choice(parts) for _ in range(rng.randint(2, 50))))
        cut = rng.randint(1, len(word) - 1)
        halves = vocab.fragment_ids(word[:cut], False), vocab.fragment_ids(word[cut:], True)
        assert bpe.join_ids(vocab, *halves) == vocab.word_ids(word)


def test_separator_scan_over_small_blocks(spark):
    rows = separator_scan.write_flat_files(docs(spark, *TEXTS), PATH, 49407, file_bytes=500)
    counts = separator_scan.count_tokens(rows, 49407, block_ids=16).join(rows, ["file", "ordinal"])
    plain = vocabulary(PATH, True)
    got = {r.doc_id: (r.n_tokens, r.closed) for r in counts.collect()}
    assert got == {i: (len(plain.encode([t or ""])[0]) // 4, True) for i, t in enumerate(TEXTS)}


def test_unclosed_tail_of_a_file(spark, tmp_path):
    path = tmp_path / "a.ids"
    np.array([5, 9, 9, 5, 5, 5], "<u2").tofile(path)
    files = spark.createDataFrame([(f"file://{path}", 2)], "file string, width int")
    rows = separator_scan.count_tokens(files, 9, block_ids=2).collect()
    assert sorted((r.ordinal, r.start, r.n_tokens, r.closed) for r in rows) == [
        (0, 0, 1, True), (1, 2, 0, True), (2, 3, 3, False)]


def test_indexed_shards(spark):
    df = docs(spark, *TEXTS, "again", ids=[*range(len(TEXTS)), 3])
    keys = token_index.write_shards(df, PATH, end_id=1, shard_docs=4)
    rows = sorted(token_index.read_documents(keys).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == sorted([*range(len(TEXTS)), 3])
    start = 0
    for r in rows:
        assert r.start == start
        start += r.n_tokens
    shard = token_index.Shard(keys.first().shard)
    here, _, _ = shard.find([f"none {i}" for i in range(50)])
    assert not here.any()


@pytest.mark.parametrize("n", [1, 2, 7, 1000, 5000])
def test_minimal_perfect_hash(n):
    hashes = token_index.key_hashes([f"k{i}" for i in range(n)])
    seeds, slots = token_index.build_index(hashes)
    assert sorted(slots.tolist()) == list(range(n))
    assert (token_index.find_slots(hashes, seeds, n) == slots).all()


# --- near copies ---------------------------------------------------------------------------------
def test_candidates_are_looked_up_before_texts_move(spark):
    frame = docs(spark, *"abcdef", ids=[1, 2, 2, 3, None, 4]).selectExpr("doc_id AS id", "text")
    met = spark.createDataFrame([(2,), (2,), (4,)], "id long")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10")
    try:
        found = near_dedup._with_candidates(frame, met)
        assert {(r.id, r.text) for r in found.collect()} == {(2, "c"), (4, "f")}
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert plan.index("SortMergeJoin") < plan.index("BroadcastHashJoin")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_near_copies(spark):
    base, other = prose(1), prose(2)
    changed = [*base[:60], "new", *base[61:]]
    far = [w if i % 6 else "odd" for i, w in enumerate(base)]
    texts = [" ".join(x) for x in (base, other, changed, far)] + [" ".join(base).upper(), None, "", "one two", "one two"]
    rows = near_dedup.near_duplicates(docs(spark, *texts)).collect()
    got = {r.doc_id: (r.class_id, r.class_size) for r in rows}
    assert got == {0: (0, 3), 1: (1, 1), 2: (0, 3), 3: (3, 1), 4: (0, 3), 5: (5, 1), 6: (6, 1),
                   7: (7, 2), 8: (7, 2)}
    assert near_dedup.near_duplicates(docs(spark)).count() == 0


def test_near_copies_hand_small_batches_to_python(spark, monkeypatch):
    key, most = "spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS
    before, real = spark.conf.get(key), near_dedup._count_cells

    def bounded(batches):
        def checked():
            for batch in batches:
                assert batch.num_rows <= most
                yield batch

        return real(checked())

    monkeypatch.setattr(near_dedup, "_count_cells", bounded)
    frame = spark.range(2 * most + 10, numPartitions=1).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("one text "), F.col("id") % 7).alias("text")
    )
    assert near_dedup.near_duplicates(frame).filter("kept").count() == 7
    assert spark.conf.get(key) == before


def five_word_runs(text):
    words = text.lower().split()
    return Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def links_of_all_pairs(texts, similarity=0.8):
    """Links under TF-IDF with exact document frequencies, and each text's frequencies."""
    runs = [five_word_runs(t) for t in texts]
    df = Counter(run for found in runs for run in found)

    def idf(run):
        return 1 + math.log(len(texts) / df[run]) / math.log(len(texts))

    links = set()
    for i, a in enumerate(runs):
        for j, b in enumerate(runs[:i]):
            if len(a.keys() & b.keys()) * 2 < len(a):  # never alike: IDF is 2 at most
                continue
            common = sum(min(n, b[run]) * idf(run) for run, n in a.items())
            either = sum(max(a[run], b[run]) * idf(run) for run in a.keys() | b.keys())
            if common >= similarity * either:
                links.add((j, i))
    return links, [sorted(df[run] for run in found) for found in runs]


def test_document_frequencies_are_exact(spark):
    shared = prose(900, 130)
    texts = [" ".join(prose(i, 120)) for i in range(250)]
    hot = prose(901, 60)  # a third of the rows
    texts += [" ".join([*hot[: i % 60], f"copy{i}", *hot[i % 60 :]]) for i in range(125)]
    # alike in 126 of 156 runs: linked if each run counts as one text's, not at three texts each
    texts += [" ".join(shared + prose(910 + i, 15)) for i in range(3)]
    links, frequencies = links_of_all_pairs(texts)
    frame = docs(spark, *texts)
    weights = near_dedup.corpus_weights(frame)
    got = [sorted(weights.frequencies(near_dedup.shingles([t])[0]).tolist()) for t in texts]
    assert got == frequencies
    rows = near_dedup.near_duplicates(frame).collect()
    classes = list(range(len(texts)))
    for a, b in sorted(links):
        low, high = sorted((classes[a], classes[b]))
        classes = [low if c == high else c for c in classes]
    assert {r.doc_id: r.class_id for r in rows} == dict(enumerate(classes))
    assert {r.class_id for r in rows if r.doc_id >= 375} == {375, 376, 377}


def test_rare_shingles_weigh_as_the_floor(spark, monkeypatch):
    hot = prose(901, 60)
    texts = [" ".join(prose(i, 60)) for i in range(40)] + [" ".join([*hot, f"copy{i}"]) for i in range(20)]
    texts += ["", None, "two words"]
    monkeypatch.setattr(near_dedup, "FREQUENT", 1 << 9)
    weights = near_dedup.corpus_weights(docs(spark, *texts))
    _, frequencies = links_of_all_pairs([t for t in texts if t])
    held = sum(map(len, frequencies)) + 1  # "two words" is one shingle
    assert weights.floor == held // (1 << 9) > 1
    assert len(weights.hashes) < 1 << 9
    for text, want in zip(texts[:60], frequencies, strict=False):
        found = near_dedup.shingles([text])[0]
        assert sorted(weights.frequencies(found).tolist()) == [max(n, weights.floor) for n in want]
        assert ((1 <= weights.of(found, 1)) & (weights.of(found, 1) <= 2)).all()


def test_samples_agree_as_often_as_texts_are_alike():
    a, b = prose(7, 400), prose(8, 400)
    texts = [" ".join(a), " ".join([*a[:300], *b[300:]])]
    hashes, tf, per_text = near_dedup.shingles(texts)
    common = np.intersect1d(hashes[: per_text[0]], hashes[per_text[0] :])[:150]
    weights = near_dedup.Weights(1000, 1, common, np.full(150, 900))  # half of the shared ones
    w = weights.of(hashes, tf)
    n = per_text[0]
    alike = near_dedup.weighted_jaccard(hashes[:n], w[:n], hashes[n:], w[n:])
    assert abs(alike - near_dedup.weighted_jaccard(hashes[:n], tf[:n], hashes[n:], tf[n:])) > 0.05
    found = []
    for turn in range(40):  # other hashes, other draws
        moved = near_dedup._mix(hashes + np.uint64(turn))
        one, two = near_dedup.samples(moved, w.astype(np.float32), per_text)
        found.append((one == two).mean())
    assert abs(np.mean(found) - alike) < 0.03


def test_a_long_text_is_shingled_in_pieces():
    import tracemalloc

    words = prose(5, 3000)
    text = " ".join(words * 900)  # about 20 million signs
    tracemalloc.start()
    hashes, tf, per_text = near_dedup.shingles([text])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 20 * len(text)
    assert per_text.tolist() == [len(hashes)] and tf.sum() == 3000 * 900 - 4
    short = near_dedup.shingles([" ".join(words * 2), "x"])
    assert np.isin(short[0][: short[2][0]], hashes).all() and len(hashes) == short[2][0]


def test_an_id_with_several_texts(spark):
    base = prose(1)
    near, other = " ".join([*base[:60], "new", *base[61:]]), " ".join(prose(2))
    odd = " ".join([*prose(2)[:50], "new", *prose(2)[51:]])
    texts = [" ".join(base), other, near, "~~~", None, odd, None]
    frame = docs(spark, *texts, ids=[3, 5, 5, 5, 5, 9, None])
    rows = near_dedup.near_classes(frame).collect()
    got = sorted((r.doc_id or 0, r.class_id or 0, r.class_size, r.kept) for r in rows)
    assert got == [(0, 0, 1, True), (3, 3, 2, True), (5, 3, 2, False), (5, 5, 1, True),
                   (5, 5, 1, True), (5, 5, 2, True), (9, 5, 2, False)]
    kept = corpus_pipeline.drop_near_copies(spark, frame, "").collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in kept) == sorted(
        [(0, ""), (3, texts[0]), (5, other), (5, "~~~"), (5, "")]
    )


def test_mixed_buckets_are_compared_in_blocks(spark):
    texts = {i: " ".join(prose(i % 3)) for i in range(9)}
    frame = docs(spark, *texts.values())
    weights = near_dedup.corpus_weights(frame)
    members = spark.createDataFrame([(1, i, 200.0) for i in range(9)], "band long, id long, mass double")
    mixed = near_dedup._mixed(members, spark.createDataFrame([(0, 3)], "a long, b long"))
    pool = frame.select(F.col("doc_id").alias("id"), "text")
    found = near_dedup._block_links(mixed, pool, near_dedup._verify(weights, 0.8), 0.8)
    links = found.union(spark.createDataFrame([(0, 3)], "a long, b long"))
    classes = {r.id: r.component for r in near_dedup.components(links).collect()}
    assert classes == {i: i % 3 for i in range(9)}


def test_blocks_and_classes_of_mass_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "GROUP", 4)
    rng = random.Random(4)
    base, texts = prose(1, 400), []
    for i in range(60):  # texts of many lengths that share their first words
        n = rng.randrange(60, 400)
        texts.append(" ".join([*base[:n], *prose(100 + i, rng.randrange(0, 40))]))
    frame = docs(spark, *texts)
    weights = near_dedup.corpus_weights(frame)
    found = [near_dedup.shingles([t])[:2] for t in texts]
    w = [weights.of(h, tf) for h, tf in found]
    want = {
        (i, j)
        for j in range(60)
        for i in range(j)
        if near_dedup.weighted_jaccard(found[i][0], w[i], found[j][0], w[j]) >= 0.8
    }
    members = spark.createDataFrame(
        [(1, i, float(w[i].sum())) for i in range(60)], "band long, id long, mass double"
    )
    i, j = min(want)
    known = spark.createDataFrame([(i, j)], "a long, b long")
    pool = frame.select(F.col("doc_id").alias("id"), "text")
    mixed = near_dedup._mixed(members, known)
    links = near_dedup._block_links(mixed, pool, near_dedup._verify(weights, 0.8), 0.8)
    assert {tuple(sorted(r)) for r in links.collect()} <= want
    classes = {r.id: r.component for r in near_dedup.components(links.union(known)).collect()}
    expected = list(range(60))
    for a, b in sorted(want):
        low, high = sorted((expected[a], expected[b]))
        expected = [low if c == high else c for c in expected]
    assert {i: classes.get(i, i) for i in range(60)} == dict(enumerate(expected))
    assert 1 < len(set(expected)) < 60


# --- vectors ------------------------------------------------------------------------------------
def test_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(6, 20))
    data = [(centres[i % 6] + 0.3 * rng.normal(size=20)).tolist() for i in range(150)]
    data += [data[0], data[0], None, [0.0] * 20, [float("nan")] * 20, [None] * 20, []]
    labels = [i % 3 if i % 11 else None for i in range(len(data))]
    labels[150] = labels[151] = labels[0]
    rows = [(i, v, k, 1) for i, (v, k) in enumerate(zip(data, labels, strict=True))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, rep int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in vectors.near_vectors(df, 0.9, tile=8).collect()}
    good = [i for i in range(152) if labels[i] is not None]
    x = np.array([data[i] for i in good])
    x /= np.linalg.norm(x, axis=1)[:, None]
    k = np.array([labels[i] for i in good])
    link = (x @ x.T >= 0.9) & (k[:, None] == k[None, :])
    np.fill_diagonal(link, False)
    root = np.array(good)
    for _ in good:
        root = np.minimum(root, np.where(link, root[None, :], 1 << 40).min(axis=1))
    want = {i: (0, i) for i in range(len(data))}
    want |= {i: (int(n), int(c)) for i, n, c in zip(good, link.sum(1), root, strict=True)}
    assert got == want


# --- toxicity, language -------------------------------------------------------------------------
def all_maximal_segments(scores, start=0):
    """The best segment, then those left and right of it, until none is above zero."""
    spans = [(sum(scores[i : j + 1]), -i, -j) for i in range(len(scores)) for j in range(i, len(scores))]
    best, i, j = max(spans, default=(0, 0, 0))
    if best <= 0:
        return []
    i, j = -i, -j
    left = all_maximal_segments(scores[:i], start)
    right = all_maximal_segments(scores[j + 1 :], start + j + 1)
    return [*left, (start + i, start + j, best), *right]


def test_maximal_segments_against_all_intervals():
    rng = random.Random(1)
    for _ in range(300):
        scores = [rng.uniform(-2, 1.5) for _ in range(rng.randrange(0, 16))]
        found = toxicity.maximal_segments(np.array(scores))
        want = all_maximal_segments(scores)
        assert [f[:2] for f in found] == [w[:2] for w in want]
        assert [f[2] for f in found] == pytest.approx([w[2] for w in want])


def test_words_score_as_their_most_telling_token():
    model = toxicity.Model.of({"vile": 2.0, "vil-": 0.5, "kind": -1.5, "kin-": 0.25})
    words = ["vile", "vilest", "kind", "kin", "kinder", "other", "vile"]
    assert model.word_scores(words).tolist() == [2.0, 0.5, -1.5, 0.25, 0.25, 0.0, 2.0]
    assert toxicity.Model().word_scores(["any"]).tolist() == [0.0]
    odds = toxicity.shrunk_log_odds(np.array([9.0, 1, 0, 5]), np.array([9.0, 1, 40, 20]))
    assert odds[0] > 4 * odds[1] > 0 > odds[2], "known better, and harmless ones below zero"
    assert len(set(toxicity.extreme_values(np.zeros(0), 10))) == 2, "no segment to fit to"


def test_many_small_groups_are_compared_at_once(monkeypatch):
    calls, shingles = [], near_dedup.shingles

    def counted(texts):
        calls.append(len(texts))
        return shingles(texts)

    monkeypatch.setattr(near_dedup, "shingles", counted)
    rows = []
    for g in range(100):  # a leader, a near copy of it and another text; then three near copies
        words = prose(g, 60)
        near, other = " ".join([*words, "end"]), " ".join(prose(500 + g, 60))
        three = [(g, 0, " ".join(words)), (g, 1, near), (g, 1, other)]
        if g % 2:
            three = [(g, near_dedup.BOTH, " ".join([*words, f"w{i}"])) for i in range(3)]
        rows += [(*row[:2], 10 * g + i, row[2]) for i, row in enumerate(three)]
    key, side, ids, texts = zip(*rows, strict=True)
    table = pa.table({"key": key, "id": ids, "comp": ids, "side": pa.array(side, pa.int32()), "text": texts})
    check = near_dedup._verify(near_dedup.Weights(1000, 1, np.zeros(0, np.uint64), np.zeros(0, np.int64)), 0.8)
    # batches end inside groups
    found = pa.Table.from_batches(check(iter(table.to_batches(max_chunksize=7)))).to_pylist()
    want = {(10 * g, 10 * g + i) for g in range(100) for i in ((1, 2) if g % 2 else (1,))}
    assert {(r["a"], r["b"]) for r in found} == want
    assert calls == [300], "once per about 2**18 signs, not once per group"


def test_toxicity_takes_text_ids_repeated_rows_and_empty_tables(spark):
    texts = [(f"t{i}", " ".join(prose(i, 30) + ["vile"] * (i % 4 == 0))) for i in range(120)]
    df = spark.createDataFrame(texts * 2, "doc_id string, text string")
    labels = spark.createDataFrame([(f"t{i}", int(i % 4 == 0)) for i in range(120)] * 3,
                                   "doc_id string, toxic int")
    model, once = toxicity.fit(df, labels), toxicity.fit(df.dropDuplicates(), labels.dropDuplicates())
    assert np.array_equal(model.weights, once.weights) and model.slope == pytest.approx(once.slope)
    rows = toxicity.score(df, model).collect()
    assert len(rows) == 240
    assert all(r.predicted == int(int(r.doc_id[1:]) % 4 == 0) for r in rows)
    assert len(toxicity.fit(df.limit(0), labels).tokens) == 0
    assert toxicity.score(df.limit(0), model).count() == 0


def test_training_rows_leave_in_small_batches():
    texts = ["", *[" ".join(f"w{i}x{j}" for j in range(9000)) for i in range(12)], "a b"]
    batch = pa.RecordBatch.from_pydict({"toxic": pa.array([1, 0] * 7, pa.int32()), "text": texts})
    found = list(toxicity._train_rows(iter([batch, batch.slice(0, 0), batch.slice(0, 1)])))
    assert [b.num_rows for b in found] == [5, 4, 4, 2], "about 2**18 signs each"
    rows = pa.Table.from_batches(found).to_pylist()
    assert [r["toxic"] for r in rows] == [1, 0] * 7 + [1]
    named = sorted(xxhash.xxh3_64_intdigest(t) for t in "ab")
    assert [t % (1 << 64) for t in rows[13]["tokens"]] == named and len(rows[1]["tokens"]) == 2
    assert rows[0]["tokens"] == [] and len({r["key"] for r in rows}) == 3


def test_counts_reach_the_driver_deflated():
    rows = np.zeros((5000, 9), np.int64)
    rows[:, 0], rows[::7, 3] = np.arange(5000) * 1234567891011 - (1 << 61), 1 << 40
    names = [f"c{i}" for i in range(9)]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in rows.T], names)
    sent = [r.as_py() for b in toxicity._packed(iter([batch, batch])) for r in b.column("raw")]
    assert sum(map(len, sent)) < rows.nbytes  # half of what the two batches hold
    assert (toxicity._unpacked(sent, 9) == np.concatenate([rows, rows])).all()
    assert toxicity._unpacked([], 9).shape == (0, 9)


def test_toxicity_learns_and_leaves_clean_rows(spark):
    texts = [" ".join(prose(i, 40) + (["vile"] if i % 4 == 0 else [])) for i in range(400)]
    df = docs(spark, *texts, None, "")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)], "doc_id long, toxic int")
    model = toxicity.fit(df, labels)
    rows = toxicity.score(df, model).collect()
    out = [r for r in rows if r.held_out and r.doc_id < 400]
    assert out and all(r.predicted == int(r.doc_id % 4 == 0) for r in out)
    assert toxicity.clean_rows(df, model).columns == df.columns
    empty = toxicity.fit(df, labels.filter("toxic = 5"))
    assert {r.predicted for r in toxicity.score(df, empty).collect()} == {0}


def test_toxic_rows_with_a_passage_in_common_all_count(spark):
    least = min(range(3000), key=lambda s: xxhash.xxh3_64_intdigest(" ".join(prose(s, 5))))
    passage = prose(least, 5)  # its only run of five words is the smallest of nearly every row
    texts = [" ".join(prose(5000 + i, 25) + (["vile", *passage] if i % 4 == 0 else [])) for i in range(200)]
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(200)], "doc_id long, toxic int")
    many = toxicity.fit(docs(spark, *texts), labels).word_scores(["vile"])[0]
    copies = [" ".join(prose(7000 + i, 25)) for i in range(150)] + [" ".join([*prose(2), "vile"])] * 50
    labels = spark.createDataFrame([(i, int(i >= 150)) for i in range(200)], "doc_id long, toxic int")
    one = toxicity.fit(docs(spark, *copies), labels).word_scores(["vile"])[0]
    assert many > 2 and many > 3 * one, "copies of one row say as much as one row"


def test_language_fusion(spark):
    de, en = "der die und nicht eine mit ", "the and of with not from "
    train = spark.createDataFrame(
        [(i, (de if i % 2 else en) * 5, "de" if i % 2 else "en") for i in range(40)],
        "doc_id long, text string, lang string",
    )
    model = language.fit_text_model(train)
    pages = [(i, f"http://a{i % 2}.example.{'de' if i % 2 else 'com'}/x",
              f"<html lang='{'de' if i % 2 else 'en'}'><script>the</script><p>{(de if i % 2 else en)}</p>", 1)
             for i in range(40)]
    pages += [(40, "http://a1.example.de/", None, 1), (41, None, f"<p>{de}</p>", 1), (42, None, None, 1)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string, p int")
    got = {r.page_id: r.lang for r in language.languages_of(df, model).collect()}
    assert all(got[i] == ("de" if i % 2 else "en") for i in range(40))
    assert got[40] == "de" and got[41] == "de" and got[42] in ("de", "en")
    assert language.languages_of(df.limit(0), model).count() == 0
