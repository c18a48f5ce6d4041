"""Operators 11 to 13 against brute force, the libraries and held-out accuracy, and their edge cases."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

pytest.importorskip("quaymark.llm")
from quaymark.llm import alignment, phrases, queries, toxicity  # noqa: E402

SF = "/root/testdata/sf0.001"
EDGE = [(1, None, "en"), (2, "", "en"), (3, "   \n\t ", None), (4, "a b", "de"), (5, "word " * 30_000, "en"), (6, "x" * 20_000, "en"), (7, "Der Rat. 漢字 é😀 ▁ ", "de"), (7, "Der Rat. 漢字 é😀 ▁ ", "de"), (None, "null id text here now", "en")]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, phrase string, pair string"


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame([(i, t, lang, None, None, "clash", "clash", "clash") for i, t, lang in EDGE], SCHEMA)


# Alignment.


@pytest.fixture(scope="module")
def vocabularies():
    return queries.vocabulary("byte_bpe_50k.json"), queries.vocabulary("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def plainly(vocabularies):
    """What one text gives, token by token from the libraries."""
    tokenizers, sentencepiece = pytest.importorskip("tokenizers"), pytest.importorskip("sentencepiece")
    a = tokenizers.Tokenizer.from_file(vocabularies[0])
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=vocabularies[1])
    byte, token = alignment.byte_of_char(), {i: t for t, i in a.get_vocab().items()}

    def run(text):
        nothing = (0, 0, 0, "", [])
        if not text:
            return nothing
        ids = a.encode(f" {text}", add_special_tokens=False).ids, b.encode(text)
        pieces = [bytes(byte[c] for c in token[i]) for i in ids[0]], [bytes([int(b.id_to_piece(i)[3:-1], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids[1]]
        if any(b"".join(p) != f" {text}".encode() for p in pieces):
            return nothing
        ends = [{e: k for k, e in enumerate(np.cumsum([len(x) for x in p]).tolist())} for p in pieces]
        groups, links, last = [], [], (-1, -1)
        for cut in sorted(ends[0].keys() & ends[1].keys()):
            now = ends[0][cut], ends[1][cut]
            groups.append("|".join(",".join(map(str, ids[s][last[s] + 1 : now[s] + 1])) for s in (0, 1)))
            links.append((ids[0][now[0]], ids[1][now[1]]))
            last = now
        return len(ids[0]), len(ids[1]), len(groups), hashlib.sha256(";".join(groups).encode()).hexdigest(), links

    return run


def odd_texts(n):
    r = random.Random(5)
    parts = [*"abcdeétßz  \n\n  ..,'sABC019<|>", "\t", "\r", "\x01", "\xa0", " ", "▁", "😀", "中文", "<|endoftext|>", "<s>", "\x85", "\x1c", "'ll", "　", "\x00", " the", "ing ", "\x0b", "�", "​", "<0x41>", "<unk>"]
    return ["".join(r.choice(parts if r.random() < 0.7 else parts[:20]) for _ in range(r.randint(0, 60))) for _ in range(n)] + ["", " ", "\n", "  \n ", "a", "▁", "word \n", " x", "a" * 5000, "\x01" * 3]


def test_digest_equals_libraries(vocabularies, plainly):
    texts = odd_texts(2000)
    encoder = alignment.PairEncoder(*vocabularies, entries=500)  # forgets again and again
    for i in range(0, len(texts), 200):
        part = texts[i : i + 200]
        counts, hashes, pairs, owner = encoder.digest(part)
        for k, text in enumerate(part):
            links = [(p >> 24, p & 0xFFFFFF) for p in pairs[owner == k].tolist()]
            assert (*(int(c[k]) for c in counts), hashes[k], links) == plainly(text), text


def expected_alignment(texts, plainly):
    told = [plainly(t) for t in texts]
    n = Counter(link for x in told for link in x[4])
    best = {}
    for (_, b), c in n.items():
        best[b] = max(best.get(b, 0), c)
    return [(x[0], x[1], x[2], len(x[4]), sum(n[link] == best[link[1]] for link in x[4]), sum(n[link] for link in x[4]), x[3]) for x in told]


@pytest.mark.parametrize("broadcast_pairs", [10**6, 3])
def test_aligned_documents(spark, edge, vocabularies, plainly, broadcast_pairs):
    texts = [t for _, t, _ in EDGE] + odd_texts(150)
    docs = edge.unionByName(spark.createDataFrame([(1000 + i, t, "en", None, None, "c", "c", "c") for i, t in enumerate(texts[len(EDGE) :])], SCHEMA))
    got = alignment.align_documents(docs, *vocabularies, broadcast_pairs=broadcast_pairs).collect()
    ids = [i for i, _, _ in EDGE] + [1000 + i for i in range(len(texts) - len(EDGE))]
    want = [(i, *x) for i, x in zip(ids, expected_alignment(texts, plainly), strict=True)]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert alignment.align_documents(docs.limit(0), *vocabularies).count() == 0


# Collocations.


def plain_collocations(rows, threshold, most):
    n, f = Counter(), {}
    for text, lang in rows:
        lang = "und" if lang is None else lang
        own = f.setdefault(lang, Counter())
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            words = [w for w in re.split("[\x20\x09]+", piece) if w]
            n[lang] += len(words)
            for k in range(1, 6):
                own.update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, own in f.items():
        found = {p: a for p, a in own.items() if len(p) > 1 and a >= threshold}
        inside = Counter()
        for q, a in found.items():
            for k in range(2, len(q)):
                for i in range(len(q) - k + 1):
                    inside[q[i : i + k]] = max(inside[q[i : i + k]], a)
        ranked = []
        for p, a in found.items():
            if inside[p] < a:
                score, k = min((1000 * a * n[lang] // (own[p[:k]] * own[p[k:]]), k) for k in range(1, len(p)))
                ranked.append((-score, -a, " ".join(p).encode(), own[p[:k]], own[p[k:]]))
        out += [(lang, i, x[2].decode(), -x[1], x[3], x[4], n[lang], -x[0]) for i, x in enumerate(sorted(ranked)[:most], 1)]
    return sorted(out)


@pytest.mark.parametrize(("size", "bits"), [(phrases.SHARD, phrases.MOST_BITS), (300, 6)])  # tiny shards, and a sketch that lets all through
def test_collocations_equal_brute_force(spark, size, bits):
    r = random.Random(2)
    words = ["New", "york", "é", "x\xa0y", "a", "b", "c", "\x00", "漢字", "of", "the", "\x85", "|"]
    rows = [("".join(r.choice(words) + r.choice([" ", " ", " ", "  ", "\t", ". ", "\n", ",", "\x0b", ""]) for _ in range(r.randint(0, 80))), r.choice(["en", "de", None, "und", ""])) for _ in range(300)]
    rows += [(None, "en"), ("", None), ("a a a a a a a", "de"), ("New York of the " * 50, "en"), ("word", None)]
    docs = spark.createDataFrame([(i, t, lang, "clash") for i, (t, lang) in enumerate(rows)], "doc_id long, text string, lang string, phrase string")
    got = phrases.mine(docs, threshold=12, most=40, size=size, most_bits=bits).collect()
    assert sorted(map(tuple, got)) == plain_collocations(rows, 12, 40)
    assert phrases.mine(docs, threshold=300, most=5).count() == len(plain_collocations(rows, 300, 5))
    assert phrases.mine(docs.limit(0)).count() == 0


def test_scores_stay_exact_beyond_64_bits(spark):
    big = 10**15 + 7
    counts = spark.createDataFrame([("en", "a", 1, 3 * big), ("en", "b", 1, 2 * big), ("en", "a b", 2, big)], "lang string, phrase string, words int, n long")
    totals = spark.createDataFrame([("en", 5 * big + 1)], "lang string, n long")
    assert phrases.collocations(counts, totals).first()["score"] == 1000 * big * (5 * big + 1) // (6 * big * big)


def test_edge_rows_of_collocations(edge):
    got = phrases.mine(edge, threshold=100).collect()
    assert {(r.lang, r.phrase) for r in got} == {("en", " ".join(["word"] * k)) for k in (2, 3, 4, 5)}


# Toxicity.


def made_up(n, seed):
    r = random.Random(seed)
    syllables = ["th", "er", "on", "an", "in", "es", "ed", "or", "ti", "ha", "ou", "ea", "st", "nd"]
    bad = ["idiot", "moron", "scum", "worthless", "pathetic"]
    rows = []
    for i in range(n):
        words = ["".join(r.choice(syllables) for _ in range(r.randint(1, 4))) for _ in range(r.randint(20, 120))]
        toxic = i % 5 < 2
        for _ in range(max(2, len(words) // 25) if toxic else 0):
            words.insert(r.randrange(len(words)), r.choice(bad))
        rows.append((i, " ".join(words), int(toxic)))
    return rows


@pytest.fixture(scope="module")
def toxic_model(spark):
    rows = made_up(700, 1)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    return toxicity.train(docs, spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int"))


def test_toxic_words_and_misspellings(toxic_model):
    rows = made_up(400, 2)
    score = toxic_model.score([t for _, t, _ in rows])
    toxic = np.array([y for _, _, y in rows]) == 1
    assert (score[toxic] >= 0.5).mean() > 0.9 and (score[~toxic] < 0.5).mean() > 0.95
    share = lambda w: toxic_model.words(pa.array([w]))[0][0]
    plain = max(map(share, ["theron", "another", "inesti", "handou"]))
    assert min(map(share, ["idiots", "moronn", "wortless", "patheticc"])) > plain  # never seen


def test_scores_are_means_of_words(toxic_model):
    texts = ["Idiot! the (idiot), moron", "", " \n ", "...", "word " * 5000 + "scum"]
    got = toxic_model.score(texts)
    for text, score in zip(texts, got.tolist(), strict=True):
        words = [w.strip(" \t\r\n.,;:!?\"'()[]{}<>|-_*#=+/\\").lower() for w in text.split()]
        words = [w for w in words if w]
        margin = np.mean([toxic_model.words(pa.array([w]))[0][0] for w in words]) if words else None
        want = toxic_model.share if margin is None else 1 / (1 + np.exp(-(margin * toxic_model.scale[0] + toxic_model.scale[1])))
        assert score == pytest.approx(want)


def test_gradients_are_those_of_the_softmax():
    r = np.random.default_rng(3)
    units, renumber = np.ones(toxicity.BUCKETS, np.float32), np.arange(toxicity.BUCKETS, dtype=np.int32)
    bag = toxicity.Bags.of(pa.array(["idiot", "the", "the", "moron"]), np.array([0.5, 0.5, 0.25, 0.75]), np.array([2, 2]), units, renumber)
    values, errors = r.standard_normal(toxicity.BUCKETS), np.array([0.3, -0.7])
    assert float(bag.margins(values) @ errors) == pytest.approx(float(values @ bag.pull(errors)))


def test_toxicity_edges(spark, edge):
    schema = "doc_id long, toxic int, text string"
    none = toxicity.train_and_score(edge, spark.createDataFrame([], schema)).collect()
    assert len(none) == len(EDGE) and {(r.score, r.predicted) for r in none} == {(0.0, 0)}
    one = toxicity.train_and_score(edge, spark.createDataFrame([(4, 1, "clash"), (4, 1, ""), (None, 0, ""), (1, None, "")], schema)).collect()
    assert {(r.score, r.predicted) for r in one} == {(1.0, 1)}
    assert {r.doc_id: r.held_out for r in none}[None] is False
    assert toxicity.train_and_score(edge.limit(0), spark.createDataFrame([], schema)).count() == 0
    marks = toxicity.marks_of(spark.createDataFrame([(i, i % 2, "") for i in range(200)] + [(2, 1, ""), (2, 1, "")], schema), 100)
    assert not marks.where(toxicity.held_out()).count() and 30 < marks.count() < 130


def test_toxicity_on_the_driver_tables(spark):
    got = {r.doc_id: r for r in queries.op11_toxicity(spark, SF).collect()}
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got.values())
