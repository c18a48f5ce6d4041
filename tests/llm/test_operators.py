"""The ten operators against brute force, exact round trips and held-out accuracy, and their edge cases."""

import hashlib
import html
import random
import re
import struct
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

pytest.importorskip("quaymark.llm")
from quaymark.llm import components, decontaminate, htmlwrap, jaccard, langid, media, packing, pii, quality, queries, tokencount, tokenstore, wordids  # noqa: E402

SF = "/root/testdata/sf0.001"
EDGE = [(1, None), (2, ""), (3, "   \n\t "), (4, "a b"), (5, "word " * 30000), (6, "x" * 20000), (7, "Der Rat. 漢字 é😀 "), (7, "Der Rat. 漢字 é😀 "), (None, "null id text here now")]


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def edge(spark, n=len(EDGE)):
    rows = [(i, t, None, None, None, "clash") for i, t in EDGE[:n]]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, token string")


def random_texts(n):
    r = random.Random(5)
    parts = ["a", "B", "the", "▁", " ", "  ", "\n", "é", "ß", "漢", "😀", "\t", "0", "'s", "--", "==", "   ", "\x00", "ing", "́", "\r\n", " ", "\xa0", "<|endoftext|>", "<|ENDOFTEXT|>", "\x01", "İ", "Σ", ".", ",", "<s>", " " * 40]
    return ["".join(r.choice(parts) for _ in range(r.randint(0, 60))) for _ in range(n)] + ["a" * 3000, " " * 2000, "\n" * 9]


def test_token_counts_equal_library():
    sentencepiece = pytest.importorskip("sentencepiece")
    path = queries.vocabulary("piece_bpe_32k.model")
    texts = random_texts(3000)
    assert tokencount.PieceModel(path).count(texts) == [len(x) for x in sentencepiece.SentencePieceProcessor(model_file=path).encode(texts, num_threads=1)]


def coded_ids(path, texts, **kw):
    """The ids of each text as bytes."""
    flat, stops = wordids.ChunkEncoder(path, **kw).encode(texts)
    return [x.tobytes() for x in np.split(flat, stops[:-1])] if texts else []


def test_chunk_ids_equal_library():
    tokenizers = pytest.importorskip("tokenizers")
    path = queries.vocabulary("word_bpe_49k.json")
    texts = random_texts(3000) + ["plain words, one. two", "a..b", "x.,y"]
    whole = tokenizers.Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)
    whole = [np.array(e.ids, "<u4").tobytes() for e in whole]
    assert coded_ids(path, texts) == whole
    small = wordids.ChunkEncoder(path, entries=300)  # forgets again and again
    for i in range(0, len(texts), 100):
        flat, stops = small.encode(texts[i : i + 100])
        assert [x.tobytes() for x in np.split(flat, stops[:-1])] == whole[i : i + 100]


def test_token_store_round_trip(spark, documents):
    path = queries.vocabulary("word_bpe_49k.json")
    for docs in (documents, edge(spark, 8), documents.limit(0)):
        rows = sorted(((r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()))
        coded = coded_ids(path, [t for _, t in rows])
        expected, start = [], 0
        for (i, _), x in zip(rows, coded, strict=True):
            x += b"\2\0\0\0"
            expected.append((i, start, len(x) // 4, zlib.crc32(x)))
            start += len(x) // 4
        assert sorted(tuple(r) for r in tokenstore.store_and_digest(docs, path).collect()) == sorted(expected)


def test_media_round_trip(spark, documents):
    for docs in (documents, edge(spark, 8)):
        texts = defaultdict(list)
        for r in docs.select("doc_id", "text").collect():
            texts[r.doc_id].append((r.text or "").encode())
        for r in media.media_digest(docs).collect():
            raw = texts[r.doc_id][0]
            padded = raw + bytes(max(64, -(-len(raw) // 64) * 64) - len(raw))
            assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(padded), hashlib.sha256(padded).hexdigest(), zlib.crc32(padded[-64:]))
            assert r.media_sha256 == hashlib.sha256(media.wav(padded)).hexdigest() and "type=audio/wav" in r.feature


def test_sniffing_carves_and_corrects():
    def chunk(kind, data):
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    png = b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", 1, 1, 8, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(b"\0\0")) + chunk(b"IEND", b"")
    gz = zlib.compressobj(wbits=31)
    gz = gz.compress(b"hello") + gz.flush()
    assert media.sniff(png, "image/jpeg") == ("image/png", [])
    assert media.sniff(b"junk" + png + b"--" + gz, "x/y") == ("x/y", [("image/png", 4, len(png)), ("application/gzip", 6 + len(png), len(gz))])
    assert media.sniff(media.wav(b"ab" + png + b"c"), None) == ("audio/wav", [("image/png", 46, len(png))])
    assert media.sniff(png[:-3], "x/y") == ("x/y", []) and media.sniff(None) == (None, []) and media.sniff(b"RIFF", "t") == ("t", [])


def test_language_held_out(spark, documents):
    rows = langid.identify(documents).join(documents.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)
    assert {r.lang_pred for r in langid.identify(edge(spark)).collect()} == {"und"}
    none = langid.predict(edge(spark), langid.train(documents)).where("doc_id in (1, 2, 3)").collect()
    assert all(r.lang_pred == "und" and r.score == 0 for r in none)


def test_html_extraction(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r.page_id: r.text for r in htmlwrap.extract_main_text(pages).collect()}
    for r in pages.collect():
        body = re.search(r"<article>(.*?)(</article>|\Z)", r.html, re.S)[1].replace("<br>", " ")
        blocks = (" ".join(html.unescape(re.sub(r"<[^>]+>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", body))
        assert got[r.page_id] == "\n".join(b for b in blocks if b)


def test_html_edges(spark):
    page = "<header><h1>Site</h1></header><div class='cookie-notice'>No</div><main><h2>T&eacute;st</h2><p>One\n two<div class='ad'>Buy</div><form>F</form><aside>S</aside><p>Three<script>'</p>'</script></main><div id=comments>bad</div>"
    rows = [(1, "https://h.example/a", page), (2, None, None), (3, "::bad", ""), (4, "https://h2.example/", "<div>Only <b>this</b></div><footer>f</footer>")]
    got = {r.page_id: (r.text, r.n_chars) for r in htmlwrap.extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {1: ("Tést\nOne two\nThree", 18), 2: ("", 0), 3: ("", 0), 4: ("Only this", 9)}


def test_wrapper_alignment():
    def items(paths):
        return htmlwrap.fold([(p, "m", p) for p in paths])

    both = htmlwrap.align(items(["h", "p", "p", "f"]), items(["h", "q", "p", "f"]))
    assert [(x[0], x[1], x[2], x[4]) for x in both] == [("h", False, False, 2), ("q", True, False, 1), ("p", False, True, 2), ("f", False, False, 2)]
    assert max(both[0][6].values()) == 2


def extracted(spark, rows):
    return {r.page_id: r.text for r in htmlwrap.extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}


def test_wrappers_decide_without_names(spark):
    """Hosts without telling names: what is constant on a host's pages is template, the densest container is the article."""
    r = random.Random(11)
    sentence = lambda: " ".join(f"w{r.randrange(9999)}" for _ in range(20))
    rows, expected = [], {}
    for i in range(24):
        paragraphs = [sentence() for _ in range(r.randint(1, 5))]
        title, kind = sentence()[:30].strip(), i % 3
        main = "".join(f"<p>{p}</p>" for p in paragraphs)
        if kind == 0:
            page = f"<div class='x1'>Home News About</div><div class='x2'><div class='x3'><h1>{title}</h1>{main}</div></div><div class='x9'>All rights with us</div>"
        elif kind == 1:
            page = f"<table><tr><td class='q'>Start<td>Map</table><h1>{title}</h1><div class='z17'>{main}<div>Tell your friends</div></div><div class='k'>End of page</div>"
        else:
            page = f"<div class='a'><ul><li>One<li>Two<li>Three</ul></div><section class='b'><div>{title}</div>{main}</section><span>Made by hand</span>"
        rows.append((i, f"https://host{kind}.example/{i}", page))
        expected[i] = "\n".join([title, *paragraphs])
    assert extracted(spark, rows) == expected
    assert extracted(spark, [(1, *rows[0][1:])] * 6)[1] == expected[0]  # in copies of one page nothing is constant


def test_names_of_boilerplate(spark):
    body = "<article><header><h1>Title</h1></header><p class='share-price'>Up</p><div class='post-ad-free'>Kept</div><div class='ad-slot'>Buy</div><p>Text</p><footer>By us</footer></article>"
    page = f"<nav>Menu</nav>{body}<article class='comment'>Nice!</article><div id='comment-list'><article>More</article></div><div class='siteFooter'>c</div>"
    rows = [(1, "https://a.example/1", page), (None, "https://a.example/1", page), (2, "https://b.example/", "<h1 class='entry-title'>Head</h1><p>Body</p>"), (3, "https://c.example/", "<p>" + "long " * 200_000 + "</p>")]
    got = extracted(spark, rows)
    assert got[1] == got[None] == "Title\nUp\nKept\nText" and got[2] == "Head\nBody" and len(got[3]) == 5 * 200_000 - 1
    clash = spark.createDataFrame(rows[:1], "page_id long, url string, html string").withColumn("host", F.lit("x")).withColumn("wrapper", F.lit(3))
    assert [r.text for r in htmlwrap.extract_main_text(clash).collect()] == [got[1]] and htmlwrap.extract_main_text(clash.limit(0)).count() == 0


PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def brute_spans(text):
    out = []
    for rank, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            luhn = sum(int(c) if i % 2 == 0 else (2 * int(c) - 9 * (int(c) > 4)) for i, c in enumerate(reversed(d))) % 10 == 0
            if {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")), "card": 14 <= len(d) <= 19 and luhn, "phone": 10 <= len(d) <= 15}[kind]:
                out.append((m.start(), rank, m.end(), kind))
    return sorted(out)


def test_pii_base_spans(spark, documents):
    hard = ["a@b.c+d@e.f x@@y.z", "1.2.3.4.5 256.1.1.1 001.02.3.4", "4111 1111 1111 1111 4111-1111-1111-1111 9" + "9" * 50, "+1 (415) 555-0100. +1", "9" * 30000, "a." * 20000 + "@b.c", "😀 é x@y.zz \x01 q@r.st", None, ""]
    extra = spark.createDataFrame([(10_000 + i, t, "x") for i, t in enumerate(hard)], "doc_id long, text string, base string")
    for docs in (documents, extra):
        texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
        for r in pii.pii_digest(docs).collect():
            found = brute_spans(texts[r.doc_id])
            joined = ",".join(f"{k}:{a}:{b}" for a, _, b, k in found)
            assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest(), r
            assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(x[3] == k for x in found) for k in PATTERNS]


def test_pii_terms_and_sanitising(spark):
    rows = [(i, f"Contact Zorbax about the account q{i % 2}@mail.example now {('Quibble', 'Wobble')[i % 2]} too") for i in range(4)] + [(10 + i, "the account now about contact") for i in range(60)]
    docs = spark.createDataFrame([(i, t, i) for i, t in rows], "doc_id long, text string, key long")
    out = {r.doc_id: r for r in pii.sanitise(docs).collect()}
    assert out[0].key == 0 and "@" not in out[0].text and out[10].text == rows[4][1]
    spans = {r.doc_id: r.spans for r in pii.pii_digest(docs).collect()}
    assert spans[0] == "email:33:48,term:53:60" and spans[10] == ""
    assert out[0].text == "Contact Zorbax about the account [EMAIL] now [NAME] too"


def brute_components(rows):
    sets = {}
    for i, t in rows:
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) if w]
        sets[i] = frozenset(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else frozenset()
    ids = sorted(sets)
    edges = [(a, b) for k, a in enumerate(ids) for b in ids[:k] if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    root = dict(components.spanning([a for a, _ in edges], [b for _, b in edges]))
    return {i: (len(sets[i]), root.get(i, i)) for i in ids}


def test_near_duplicates(spark, documents):
    r = random.Random(2)
    base = [f"w{r.randrange(10**6)}" for _ in range(150)]
    family = []
    for i in range(300):  # near copies around the threshold, in more chunks than one
        words = list(base)
        for _ in range(r.randrange(0, 8)):
            words[r.randrange(len(words))] = f"x{r.randrange(10**6)}"
        family.append((50_000 + i, " ".join(words)))
    some = [(i, t) for i, t in EDGE[:7]] + family + [(60_000, "A b C d"), (60_001, "a B c d"), (60_002, "a b c")]
    extra = spark.createDataFrame([(i, t, 0) for i, t in some], "doc_id long, text string, n long")
    for docs in (documents, extra):
        got = {x.doc_id: (x.n_shingles, x.component_id) for x in jaccard.near_duplicates(docs).collect()}
        assert got == brute_components([(x.doc_id, x.text) for x in docs.select("doc_id", "text").collect()])
    assert jaccard.near_duplicates(extra.limit(0)).count() == 0


def near_family(n, seed=2):
    """Near copies around the threshold."""
    r = random.Random(seed)
    base = [f"w{r.randrange(10**6)}" for _ in range(150)]
    out = []
    for i in range(n):
        words = list(base)
        for _ in range(r.randrange(0, 8)):
            words[r.randrange(len(words))] = f"x{r.randrange(10**6)}"
        out.append((i, " ".join(words)))
    return out


@pytest.mark.parametrize("case", ["common", "chunks", "collided"])
def test_near_duplicates_of_large_families(spark, monkeypatch, case):
    """Common shingles, families of many chunks, and sets that share a fingerprint give the same components."""
    rows = near_family(260) + [(1000 + i, t) for i, t in near_family(150, 3)] + [(2000 + i, t + " and more words at the end of this one") for i, t in near_family(60, 4)]
    if case == "common":
        monkeypatch.setattr(jaccard, "SAMPLE", 1)
        monkeypatch.setattr(jaccard, "LEAST", 20)
        monkeypatch.setattr(jaccard, "HOT", 10**6)
    elif case == "chunks":
        monkeypatch.setattr(jaccard, "CHUNK_MEMBERS", 8)
    else:
        true = jaccard.fingerprints
        clash = lambda found: (len(found), true(found)[0])
        monkeypatch.setattr(jaccard, "fingerprints", clash)
        monkeypatch.setattr(jaccard, "class_of", lambda found, collided: clash(found)[len(found) in collided])
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in jaccard.near_duplicates(docs).collect()}
    assert got == brute_components(rows)


def test_near_duplicates_without_ids(spark):
    (_, a), (_, b), (_, c) = near_family(40)[:3]
    unlike = "none of these words is in any other text here"
    rows = [(None, a), (None, a), (None, b), (7, c), (None, unlike), (None, None), (3, ""), (3, "  ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("token", F.lit(1)).withColumn("root", F.lit("x"))
    linked = brute_components([(1, a), (2, b), (7, c)])
    assert {v for _, v in linked.values()} == {1}
    got = sorted((str(x.doc_id), x.n_shingles > 0, str(x.component_id)) for x in jaccard.near_duplicates(docs).collect())
    assert got == sorted([("None", True, "7")] * 3 + [("7", True, "7"), ("None", True, "None"), ("None", False, "None"), ("3", False, "3"), ("3", False, "3")])


def test_components_with_heavy_nodes(spark, monkeypatch):
    for name, value in (("UNITED", 50), ("SAMPLE", 1), ("LEAST", 5), ("HEAVY", 10**6)):
        monkeypatch.setattr(components, name, value)
    r = random.Random(1)
    edges = [(r.randrange(-200, 200), r.randrange(-200, 200)) for _ in range(120)] + [(500, k) for k in range(501, 560)] + [(-300, k) for k in range(540, 580)]
    got = {x.node: x.root for x in components.components(spark, spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == dict(components.spanning([a for a, _ in edges], [b for _, b in edges]))


def test_components_by_rounds(spark, monkeypatch):
    monkeypatch.setattr(components, "UNITED", 50)
    r = random.Random(1)
    edges = [(r.randrange(-200, 200), r.randrange(-200, 200)) for _ in range(150)]
    got = {x.node: x.root for x in components.components(spark, spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == dict(components.spanning([a for a, _ in edges], [b for _, b in edges]))


def test_decontamination(spark):
    item = "On Monday the baker Anna sold 12 loaves and 7 rolls for 30 euros while the miller brought 40 kg of flour to town"
    other = item.replace("12", "15").replace("7", "9").replace("Anna", "Bruno").replace("30", "44").replace("40", "61")
    wrong = "something else entirely that shares no passage with the question above and goes on for a while"
    docs = spark.createDataFrame([(1, f"Intro. {item} end", 1), (2, f"Other words. {other} more", 2), (3, wrong, 3), (4, None, 4), (5, "", 5)], "doc_id long, text string, item_id long")
    bench = spark.createDataFrame([(9, item, "x"), (8, None, "y"), (7, "5 6 7", "z")], "item_id long, text string, doc_id string")
    got = {(r.doc_id, r.item_id, r.kind) for r in decontaminate.contaminated(docs, bench).collect()}
    assert got == {(1, 9, "copy"), (2, 9, "reparameterised")}
    assert decontaminate.contaminated(docs, bench.limit(0)).count() == 0


def test_decontamination_finds_planted(spark, documents):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    items = defaultdict(set)
    for r in bench.collect():
        w = re.findall(r"\w+", r.text.lower())
        for k in range(len(w) - 7):
            items[tuple(w[k : k + 8])].add(r.item_id)
    expected = set()
    for r in documents.select("doc_id", "text").collect():
        w = re.findall(r"\w+", r.text.lower())
        expected |= {(r.doc_id, i) for k in range(len(w) - 7) for i in items.get(tuple(w[k : k + 8]), ())}
    assert {(r.doc_id, r.item_id) for r in decontaminate.contaminated(documents, bench).collect()} == expected


def test_packing_empty_null_and_repeated(spark):
    path = queries.vocabulary("word_bpe_49k.json")
    rows = [(None, "no id"), (1, "twice"), (1, "twice"), (2, None), (2, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("part", F.lit("clash"))
    pieces = packing.pack(docs, path).collect()
    assert sorted((str(p.doc_id), p.doc_tokens) for p in pieces) == [("1", 2), ("1", 2), ("2", 1), ("2", 1), ("None", 3)]
    assert all(p.length == p.doc_tokens and p.start == 0 for p in pieces)
    assert packing.pack(docs.limit(0), path).count() == 0


def test_packing(spark, documents):
    path = queries.vocabulary("word_bpe_49k.json")
    for docs in (documents, edge(spark, 7)):
        coded = dict(zip(*(lambda rows: ([r.doc_id for r in rows], [x + b"\2\0\0\0" for x in coded_ids(path, [r.text or "" for r in rows])]))(docs.select("doc_id", "text").collect()), strict=True))
        pieces = packing.pack(docs, path).collect()
        by_doc, by_sequence = defaultdict(list), defaultdict(list)
        for p in pieces:
            ids = coded[p.doc_id]
            assert zlib.crc32(ids[4 * p.start : 4 * (p.start + p.length)]) == p.ids_crc32 and p.doc_tokens == len(ids) // 4
            by_doc[p.doc_id].append((p.start, p.length))
            by_sequence[p.sequence_id].append((p.offset, p.length))
        assert set(by_doc) == set(coded)
        for parts, whole in [*((v, len(coded[k]) // 4) for k, v in by_doc.items()), *((v, None) for v in by_sequence.values())]:
            at = 0
            for start, length in sorted(parts):
                assert start == at and length > 0
                at += length
            assert at == whole if whole else at <= 4096


def test_packing_plan_is_optimal():
    r = random.Random(4)
    for _ in range(60):
        x = np.cumsum([0] + [r.randint(1, 16) for _ in range(r.randint(1, 25))])
        cost = np.array([r.choice([0.0, 2.0, 5.0]) for _ in x])
        best = [0.0] + [float("inf")] * (len(x) - 1)
        for j in range(1, len(x)):
            for i in range(j):
                n = int(x[j] - x[i])
                if n <= 16:
                    best[j] = min(best[j], best[i] + (0 if n & (n - 1) == 0 else 16 - n) + cost[j])
        assert packing.plan(x, cost, 16)[1] == pytest.approx(best[-1])


def test_quality_held_out(spark):
    sf = SF.replace("0.001", "0.01")
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    train, test = labels.where("doc_id % 5 <> 0"), labels.where("doc_id % 5 = 0")
    rows = quality.cotrain_and_score(docs, train).join(test.select("doc_id", "quality"), "doc_id").collect()
    assert sum((r.score >= 0.5) == (r.quality == 1) for r in rows) / len(rows) > 0.85
    empty = quality.cotrain_and_score(edge(spark), labels.limit(0)).collect()
    assert len(empty) == len(EDGE) and {r.score for r in empty} == {0.5}
    assert quality.cotrain_and_score(docs.limit(0), labels).count() == 0


def two_views(n, labelled, seed=7):
    """Documents whose words and source both tell their quality; few are labelled."""
    r = random.Random(seed)
    rows, marks, truth = [], [], {}
    for i in range(n):
        good = r.random() < 0.5
        words = [f"{'good' if good == (r.random() < 0.9) else 'bad'}{r.randrange(1500)}" for _ in range(6)]
        source = f"{'fine' if good == (r.random() < 0.95) else 'poor'}{r.randrange(3)}"
        rows.append((i, " ".join(words), "en", source, 100))
        truth[i] = int(good)
        if i < labelled:
            marks += [(i, int(good))] * (1 + i % 2)
    return rows, marks, truth


def test_quality_exchange_helps_and_counts_by_brute_force(spark):
    rows, marks, truth = two_views(3000, 80)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumn("cell", F.lit("clash"))
    labels = spark.createDataFrame([*marks, (None, 1), (5, None)], "doc_id long, quality int")
    features = quality.features_of(docs, quality.marks_of(labels, 10**6)).cache()
    found = {}
    for rounds in (0, 3):
        model = quality.cotrain(features, rounds)
        scores = quality.score(features, model).collect()
        found[rounds] = sum((s.content_score >= 0.5) == (truth[s.doc_id] == 1) for s in scores) / len(scores)
    assert found[3] > found[0] + 0.03 and found[3] > 0.85
    # The counts of one round, in plain Python.
    by_words, by_cells = quality._tables(features.where("bad + good = 0"), model, 0.95)
    words, cells = defaultdict(float), defaultdict(float)
    for x in features.collect():
        if x.bad + x.good:
            continue
        content = np.mean([model.words[w] for w in x.words]) * model.word_scale[0] + model.word_scale[1]
        for z, table, keys in ((model.cells[x.cell], words, x.words), (content, cells, [x.cell])):
            if abs(z) >= np.log(19):
                for k in keys:
                    table[int(z > 0), k] += 1
    assert words and cells
    assert {(k, i): by_words[k, i] for k, i in zip(*np.nonzero(by_words), strict=True)} == words
    assert {(k, i): by_cells[k, i] for k, i in zip(*np.nonzero(by_cells), strict=True)} == cells


def test_quality_views_are_separate(spark):
    rows, marks, _ = two_views(400, 200)
    labels = spark.createDataFrame(marks, "doc_id long, quality int")
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame([*rows, (900, "same words", "en", "fine1", 7), (901, "other words!!", "en", "fine1", 7), (902, "same words", None, None, None), (902, "same words", None, None, None), (None, None, None, None, None)], schema)
    got = defaultdict(list)
    for r in quality.cotrain_and_score(docs, labels).collect():
        got[r.doc_id].append(r)
    assert got[900][0].metadata_score == got[901][0].metadata_score and got[900][0].content_score == got[902][0].content_score
    assert len(got[902]) == 2 and got[902][0] == got[902][1] and len(got[None]) == 1


def test_token_counts_of_a_table(spark):
    sentencepiece = pytest.importorskip("sentencepiece")
    path = queries.vocabulary("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    docs = edge(spark).withColumn("n_tokens", F.lit("clash"))
    rows = sorted(((str(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in tokencount.count_tokens(docs, path, 4096).collect()))
    expected = [(str(i), len((t or "").encode()), len(library.encode(t or ""))) for i, t in EDGE]
    assert rows == sorted((*e, e[2] > 4096) for e in expected)
    assert tokencount.count_tokens(docs.limit(0), path).count() == 0


def test_long_unbroken_texts():
    """Merged alone, by rank: the library's counts, in time that grows with the text."""
    import time

    sentencepiece = pytest.importorskip("sentencepiece")
    path = queries.vocabulary("piece_bpe_32k.model")
    model, library = tokencount.PieceModel(path), sentencepiece.SentencePieceProcessor(model_file=path)
    r = random.Random(8)
    texts = ["".join(r.choice("abcdefghij0123456789XYZ") for _ in range(60_000)), "ab" * 3000, "a" * 2999, "internationalization" * 200, "漢字" * 300, "▁" * 700 + "the" * 200, "x" * 257]
    began = time.perf_counter()
    found = [model.count([t])[0] for t in texts]
    assert found == [len(library.encode(t)) for t in texts] and time.perf_counter() - began < 30


def test_sniffing_is_linear_and_strict():
    import time

    began = time.perf_counter()
    for magic in (b"%PDF-", b"PK\x03\x04", b"PK\x05\x06", b"OggS", b"RIFF", b"\x89PNG\r\n\x1a\n", b"\x1f\x8b\x08"):
        assert media.sniff(magic * 100_000, "t") == ("t", [])
    assert time.perf_counter() - began < 20

    def pdf(body):
        head = b"%PDF-1.4\n" + body
        return head + b"xref\n0 1\ntrailer\nstartxref\n%d\n%%%%EOF" % len(head)

    one = pdf(b"x")
    more = one + b"\nxref\nstartxref\n%d\n%%%%EOF" % (len(one) + 1)  # an update with its own table
    assert media.sniff(more)[0] == "application/pdf" and media.sniff(b"--" + more + b"\n" + one, "t")[1] == [("application/pdf", 2, len(more)), ("application/pdf", 3 + len(more), len(one))]
    assert media.sniff(one.replace(b"startxref\n", b"startxref\n9"), "t") == ("t", [])

    def page(flags, data):
        raw = b"OggS\0" + bytes([flags]) + bytes(8) + b"abcd" + bytes(4) + bytes(4) + bytes([1, len(data)]) + data
        return raw[:22] + struct.pack("<I", media._ogg_crc(raw)) + raw[26:]

    ogg = page(2, b"one") + page(4, b"two")
    assert media.sniff(b"." + ogg)[1] == [("audio/ogg", 1, len(ogg))] and media.sniff(b"." + ogg[:-1] + b"x")[1] == []
    import io
    import zipfile

    box = io.BytesIO()
    with zipfile.ZipFile(box, "w") as z:
        z.writestr("a", "b" * 50)
        z.writestr("c", "d")
    box = box.getvalue()
    assert media.sniff(b"junk" + box + b"junk", "t") == ("t", [("application/zip", 4, len(box))])


def test_sniffing_columns(spark):
    rows = [(None, None, "x/y"), (1, b"", "x/y"), (1, media.wav(b"ab"), None)]
    df = spark.createDataFrame(rows, "doc_id long, media binary, declared string").withColumn("carved", F.lit(1)).withColumn("sniffed_type", F.lit("clash"))
    got = sorted((str(r.doc_id), str(r.sniffed_type), r.carved) for r in media.sniff_media(df).collect())
    assert got == [("1", "audio/wav", []), ("1", "x/y", []), ("None", "None", [])]
    assert media.sniff_media(df.limit(0)).count() == 0 and media.media_digest(edge(spark).limit(0)).count() == 0


def test_language_by_brute_force(spark):
    """Naive Bayes in plain Python over the same hashed n-grams."""
    r = random.Random(4)
    rows = [(i, " ".join(r.choice(w) for _ in range(r.randint(1, 9))), lang) for i in range(90) for lang, w in (("aa", ["Ungut", "tas", "é1"]), ("bb", ["gut,", "ast", "tut"]))[i % 2 : i % 2 + 1]]
    docs = spark.createDataFrame([*rows, (200, "gut", None), (None, "gut", "bb")], "doc_id long, text string, lang string").withColumn("held_out", F.lit("clash"))

    def letters(text):
        return " " + re.sub("[^a-zé]+", " ", text.lower()).strip() + " "

    def hashed(gram):
        x = len(gram)
        for k, c in enumerate(gram):
            x = ((x ^ ord(c)) * int(langid.MULTIPLIERS[k])) & 0xFFFFFFFF
            x ^= x >> 15
        return ((x * 0x27D4EB2F) & 0xFFFFFFFF) >> (32 - langid.BUCKET_BITS)

    def buckets(text):
        t = letters(text)
        return [hashed(t[i : i + n]) for n in langid.ORDERS for i in range(len(t) - n + 1)]

    learnt = [(t, lang) for i, t, lang in rows if zlib.crc32(str(i).encode()) % 3 != 1]
    counts, prior = {lang: defaultdict(int) for lang in ("aa", "bb")}, {lang: sum(x == lang for _, x in learnt) / len(learnt) for lang in ("aa", "bb")}
    for t, lang in learnt:
        for b in buckets(t):
            counts[lang][b] += 1
    size = 1 << langid.BUCKET_BITS
    found = {x.doc_id: x for x in langid.identify(docs).collect()}
    for i, t, _ in rows:
        score = {lang: np.log(prior[lang]) + sum(np.log((c[b] + 0.5) / (sum(c.values()) + size / 2)) for b in buckets(t)) for lang, c in counts.items()}
        best = max(score, key=score.get)
        assert found[i].lang_pred == best and found[i].score == pytest.approx(1 / sum(np.exp(s - score[best]) for s in score.values()), abs=1e-3)
        assert found[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1)
    assert found[None].held_out is False and found[200].lang_pred in ("aa", "bb")
    assert langid.identify(docs.limit(0)).count() == 0


def test_language_ties_and_long_texts(spark):
    train = spark.createDataFrame([(1, "abc", "yy"), (2, "abc", "xx"), (3, "zzz", "zz")], "doc_id long, text string, lang string")
    model = langid.train(train)
    assert model.score(["abc"])[0] == ["xx"]  # a tie goes to the first by name
    long = "abc " * 200_000
    assert model.score([long, "", "abc"])[0] == ["xx", "und", "xx"] and sum(len(p) for _, part in langid.pieces([long]) for p in part) == len(long)
    kept = langid.select_recognised(train.withColumn("extra", F.array(F.lit(1))), model, 0.9).collect()
    assert [(r.doc_id, r.extra) for r in kept] == [(3, [1])]


def test_pii_edges(spark):
    rows = [(None, "mail a@b.cd now"), (1, "mail a@b.cd now"), (1, "mail a@b.cd now"), (2, None), (3, "x" * 200_000 + " 1.2.3.4")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("spans", F.lit("clash"))
    got = sorted((str(r.doc_id), r.n_email, r.n_ip) for r in pii.pii_digest(docs).collect())
    assert got == [("1", 1, 0), ("1", 1, 0), ("2", 0, 0), ("3", 0, 1), ("None", 1, 0)]
    assert pii.pii_digest(docs.limit(0)).count() == 0 and pii.sanitise(docs.limit(0)).count() == 0


ITEM = "the baker sold {} loaves and {} rolls for {} euros while the miller {} brought flour to the town in the morning"


def test_decontamination_edges(spark):
    items = [(k, ITEM.format(k + 10, k + 20, k + 30, "Ann")) for k in range(300)] + [(500, ITEM.format(10, 20, 30, "Ann")), (None, ITEM.format(10, 20, 30, "Ann"))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    long = "filler word here " * 60_000 + ITEM.format(11, 21, 31, "Ann") + ". " + ITEM.format(13, 23, 33, "Ann")
    docs = spark.createDataFrame([(1, items[0][1]), (1, items[0][1]), (2, long), (3, ITEM.format(901, 902, 903, "Bob")), (None, items[5][1])], "doc_id long, text string").withColumn("item_id", F.lit("clash"))
    got = sorted((str(r.doc_id), r.item_id, r.kind, r.entries) for r in decontaminate.contaminated(docs, bench).collect())
    # One row for a copy of each different item, and one for a new instance, however many items share the template.
    assert [g for g in got if g[0] != "3"] == [("1", 0, "copy", 300), ("1", 0, "copy", 300), ("2", 1, "copy", 300), ("2", 3, "copy", 300), ("None", 5, "copy", 300)]
    assert len([g for g in got if g[0] == "3"]) == 1 and [g for g in got if g[0] == "3"][0][2] == "reparameterised"
    assert decontaminate.contaminated(docs.limit(0), bench).count() == 0


def test_words_are_described_alike_one_by_one_and_together():
    import pyarrow as pa

    words = ["Haus", "haus", "HAUS", "(haus).", "3km", "12,5", "km", "“Zitat”", "a.b", "É", "École!", "x:", "..", "²", "Ünder\".", "_a_", "don't", "ß?"]
    first, inner, flags = decontaminate.describe_all(pa.array(words))
    assert [(int(a), int(b), int(c)) for a, b, c in zip(first, inner, flags, strict=True)] == [decontaminate.describe(w)[:3] for w in words]


def gzip_member(data, extra=None, name=None, comment=None, checked=False):
    flags = 4 * (extra is not None) | 8 * (name is not None) | 16 * (comment is not None) | 2 * checked
    head = b"\x1f\x8b\x08" + bytes([flags]) + b"\0\0\0\0\0\xff"
    if extra is not None:
        head += struct.pack("<H", len(extra)) + extra
    for text in (name, comment):
        head += b"" if text is None else text + b"\0"
    if checked:
        head += struct.pack("<H", zlib.crc32(head) & 0xFFFF)
    deflate = zlib.compressobj(6, zlib.DEFLATED, -15)
    return head + deflate.compress(data) + deflate.flush() + struct.pack("<II", zlib.crc32(data), len(data))


def test_gzip_members_with_every_header_field():
    r = random.Random(1)
    for _ in range(200):
        data = bytes(r.choices(b"abc\0", k=r.choice([0, 1, 50, 5000, 200_000])))
        member = gzip_member(data, *[r.choice([None, b"", b"xyz\1"]) for _ in range(3)], r.random() < 0.5)
        assert zlib.decompressobj(31).decompress(member) == data
        before = bytes(r.choices(b"qrs\0", k=r.randint(1, 30)))
        assert media.sniff(before + member + b"--tail", "x") == ("x", [("application/gzip", len(before), len(member))])
        broken = bytearray(member)
        broken[-6] ^= 1
        assert media.sniff(before + member[:-1], "x") == media.sniff(before + bytes(broken), "x") == ("x", [])
    unclosed = b"\x1f\x8b\x08\x08" + b"\0" * 5 + b"\xff"
    assert media.sniff(unclosed * 1 + b"name without an end", "x") == ("x", [])
    assert media.sniff(b"\x1f\x8b\x08\xe0" + gzip_member(b"abc")[4:], "x") == ("x", [])
