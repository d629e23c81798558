"""Operators against brute force on small fixtures with nulls, empties, ties, copies and clashing columns."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from pyspark.sql import functions as F

from spanloom.llm import classifier, embedding_dedup, induced_sort, line_dedup, mixing, ngram_join, packing, pii, quality_rules, suffix_dedup, warc

DOC = "doc_id long, text string, lang string, source string, n_chars long, row string, rows string, n long, key string"
WORD = r"[^\x20\x09-\x0D]+"


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    say = lambda n: " ".join(rng.choice(["the", "of", "Äpfel", "and", "xyz", "lorem"]) + str(rng.randrange(60)) for _ in range(n))
    shared = "\n".join(say(30) for _ in range(4))
    texts = [None, "", " \n\t", "a", "a b c", "x\n" * 6, "same " * 80, shared, shared, say(5) + "\n" + shared + "\n" + say(9), say(900), "z" * 5000]
    for _ in range(12):
        base = say(120).split(" ")
        texts.append(" ".join(base))
        base[7] = "changed"
        texts.append(" ".join(base))
    texts += ["mail a.b@c.example.com call +1 (234) 555-0100 at 42.1.2.3 pay 4111 1111 1111 1111 not 300.1.1.1", 'key token = "0123456789abcdef0123456789abcdef01234567" end']
    return [(i, t, "en", f"src{i % 3}", len(t or ""), "r", "rr", 1, "k") for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOC)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOC)


def test_quality_rules(docs, rows, empty):
    got = {r.doc_id: r for r in quality_rules.apply_policy(quality_rules.ledger(docs)).collect()}
    for i, t, *_ in rows:
        w = re.findall(WORD, t or "")
        g = Counter(zip(w, w[1:], w[2:], strict=False))
        cover = {p + o for p in range(len(w) - 2) if g[tuple(w[p : p + 3])] > 1 for o in range(3)}
        lines = [x for x in (t or "").split("\n") if re.search(WORD, x)]
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_dup_lines, r.n_repeat_words) == (len(w), sum(map(len, w)), len(lines) - len(set(lines)), len(cover))
        assert r.base_failed == (len(w) < 50 or 100 * len(cover) > 50 * len(w)) and not (r.base_failed and r.kept)
    kept = quality_rules.keep(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if r.kept}
    assert quality_rules.ledger(empty).count() == 0
    few = {r.rule: r for r in quality_rules.ablation(quality_rules.ledger(docs)).collect()}["few_words"]
    assert few.n_failed == sum(r.n_words < 50 for r in got.values()) and few.n_kept_without == few.n_kept + few.n_only_this


def test_tokens_equal_the_library_across_generations():
    """Small generations and chunks, so that words are dropped, kept and learnt again, and gathered in many parts."""
    rng = random.Random(4)
    tokens = packing.Tokens(public_tokenizers.path("word_bpe_49k.json"))
    tokens.WORDS, tokens.CHUNK, tokens.BLOCK = 300, 200, 7
    marks = "abe\u0301\u00e9' .,;:!-_0129\u00c0\u00d6\u00df\u017f<|>\u00ad\u0130A\u030a\n\tx\u00bd\u00b2\u4e2d"
    texts = ["".join(rng.choices(marks, k=rng.choice([0, 1, 3, 10, 60]))) for _ in range(6000)]
    texts += [" ".join("".join(rng.choices("abcde", k=rng.randint(1, 6))) + rng.choice(["", ",", ".", "'s", "-x"]) for _ in range(rng.randint(0, 900))) for _ in range(40)]
    got = [x for i in range(0, len(texts), 500) for x in tokens.encode(texts[i : i + 500])]
    want = [b"".join(i.to_bytes(4, "little") for i in e.ids) for e in tokens.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert got == want and tokens.encode([]) == []


def test_packing_round_trip(docs, rows, empty):
    path = public_tokenizers.path("word_bpe_49k.json")
    out = packing.pack(docs, path, window=64, shard_rests=7).collect()
    plain = packing.Tokens(path).tokenizer
    by_doc, by_seq = {}, {}
    for r in out:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    for i, t, *_ in rows:
        ids = plain.encode(t or "", add_special_tokens=False).ids + [2]
        at = 0
        for r in sorted(by_doc[i], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    for s in by_seq.values():
        at = 0
        for r in sorted(s, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 64
    assert packing.pack(empty, path).count() == 0


def test_best_fit_takes_the_tightest():
    bins, offsets = packing.best_fit_decreasing([6, 5, 4, 3, 2], 10)
    assert bins == [0, 1, 0, 1, 1] and offsets == [0, 0, 6, 5, 8]


def test_classifier_learns_and_ignores_held_out(spark, empty):
    rng = random.Random(1)
    texts = [(i, " ".join(rng.choice("abcdefgh") * 3 + ("###" if i % 2 and rng.random() < 0.5 else "") for _ in range(60))) for i in range(300)] + [(300, None), (301, "")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1 - i % 2, 0) for i in range(300)], "doc_id long, quality int, toxic int")
    out = {r.doc_id: r for r in classifier.score(docs, *classifier.fit(docs, labels)).collect()}
    held = [i for i in range(300) if out[i].held_out]
    assert held == [i for i in range(300) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sum(out[i].predicted == 1 - i % 2 for i in held) >= 0.95 * len(held) and 0 <= out[300].score <= 1 and out[300].score == out[301].score
    assert classifier.score(empty, *classifier.fit(empty, labels.limit(0))).count() == 0


def test_scores_are_a_texts_own(spark):
    rng = np.random.default_rng(3)
    table = rng.normal(size=classifier.BUCKETS).astype(np.float32)
    texts = ["hello world", "", "a", None, "hello world", " x\ny ", "é" * 50, "to be or to be " * 900]
    alone = [classifier.score_texts([t], table, 0.1)[0] for t in texts]
    for order in (range(8), reversed(range(8)), (3, 0, 0, 7, 1)):
        order = list(order)
        assert classifier.score_texts([texts[i] for i in order], table, 0.1).tolist() == [alone[i] for i in order]
    ids = [(1 << 60) + 1, None, (1 << 60) + 3, (1 << 60) + 3]
    docs = spark.createDataFrame([(i, "some text", 1) for i in ids], "doc_id long, text string, score long")
    assert Counter(r.doc_id for r in classifier.score(docs, table, 0.1).collect()) == Counter(ids)
    packed = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json")).collect()
    assert Counter(r.doc_id for r in packed) == Counter(ids)


def test_embeddings(spark):
    rng = np.random.default_rng(0)
    base = rng.normal(size=(12, 8))
    vecs = [(i, (base[i % 12] + 0.02 * (i // 12) * rng.normal(size=8)).astype(np.float32).tolist(), i % 2) for i in range(60)]
    odd = [(60, None, 1), (61, [0.0] * 8, 1), (62, [float("nan")] * 8, 1), (63, vecs[0][1], None), (64, vecs[0][1], 0), (65, [1.0, None], 0), (66, [], 0)]
    rows = vecs + odd
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"), tile=16).collect()}
    good = [(i, np.array(e, float), label) for i, e, label in [*vecs, odd[4]]]
    near = {i: {j for j, f, m in good if j != i and label == m and e @ f / np.sqrt((e @ e) * (f @ f)) >= 0.98} for i, e, label in good}
    for i, _, _ in rows:
        seen, todo = {i}, [i]
        while todo:
            todo += (new := near.get(todo.pop(), set()) - seen)
            seen |= new
        assert got[i] == (len(near.get(i, ())), min(seen))


def test_repeated_substrings(docs, rows, empty):
    got = {r.doc_id: r for r in suffix_dedup.dedup(docs).collect()}
    raw = [(t or "").encode() for _, t, *_ in rows]
    seen = Counter(b[i : i + 400] for b in raw for i in range(len(b) - 399))
    for k, b in enumerate(raw):
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - 399):
            if seen[b[i : i + 400]] > 1:
                gone[i : i + 400] = True
        left = bytes(x for x, g in zip(b, gone, strict=False) if not g)
        runs = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        r = got[k]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (len(b), len(b) - len(left), runs, hashlib.sha256(left).hexdigest())
    assert suffix_dedup.dedup(empty).count() == 0


def test_mixing_fills_budgets(spark, docs, rows, empty):
    t = mixing.Targets({("web",): 3.0}, share=0.5, max_epochs=2)
    out = mixing.mix(docs, t, facts=True).collect()
    total = sum(len(re.findall(WORD, r[1] or "")) for r in rows)
    assert sum(r.n_tokens for r in out) <= 0.5 * total and len({(r.doc_id, r.epoch) for r in out}) == len(out)
    assert mixing.mix(docs, mixing.Targets(share=2.0, max_epochs=2)).count() == 2 * len(rows)
    assert mixing.mix(empty).count() == 0 and mixing.mix(docs, t).columns == docs.columns
    nodes = spark.createDataFrame([("a", 1.0, 10.0, 90.0), ("b", 1.0, 50.0, 90.0), ("c", 2.0, 100.0, 90.0)], "name string, weight double, cap double, above double")
    got = {r.name: round(r.budget, 6) for r in mixing.split(nodes, [], "name").collect()}
    assert got == {"a": 10.0, "b": round(80 / 3, 6), "c": round(160 / 3, 6)}


def test_pii(docs, rows, empty):
    got = {r.doc_id: r for r in pii.find(docs).collect()}
    r = got[len(rows) - 2]
    assert [len(r[k]) for k in pii.BASE] == [1, 1, 1, 1] and r.ip[0].m == "42.1.2.3"
    s = got[len(rows) - 1].secret
    assert [x.m for x in s] == ["0123456789abcdef0123456789abcdef01234567"] and s[0].start == 13
    assert not any(got[i][k] for i in range(12) for k in pii.KINDS) and pii.find(empty).count() == 0
    assert "[email]" in {x.doc_id: x.text for x in pii.redact(docs).collect()}[len(rows) - 2]


def test_warc_round_trip(spark):
    pages = spark.createDataFrame([(1, "http://A.example.com/x", "hé"), (2, None, None), (3, "http://b.example.com/", "hé"), (4, "http://b.example.com/", ""), (5, "http://c.example.org/?q=1", "solo")], "page_id long, url string, html string")
    directory, work = warc.archive(pages)
    out = {r.page_id: r for r in warc.read_all(directory, work, payloads=True).collect()}
    assert [out[i].refers_to for i in range(1, 6)] == [3, 4, None, None, None] and bytes(out[3].payload) == "hé".encode()
    assert out[1].payload_bytes == 3 and out[1].payload_digest == out[3].payload_digest == warc.digest("hé".encode())
    assert sorted(x[0] for x in warc.lookup(spark, directory, work, "http://b.example.com/")) == [3, 4]
    directory, work = warc.archive(pages.limit(0))
    assert warc.read_all(directory, work).count() == 0


def test_warc_large_null_and_repeated_ids(spark):
    big, odd = 1 << 60, "http://x.example.com/a b\r\nWARC-Type: none"
    pages = [(big + 1, "u://a/", "x"), (big + 2, "u://a/", "x"), (big + 3, "u://a/", "y" * 100_000), (None, "u://a/", "z"), (7, odd, "q"), (7, odd, "q"), (None, None, "z")]
    pages += [(i, "u://a/", f"page {i}") for i in range(1000, 1700)]
    directory, work = warc.archive(spark.createDataFrame([(*p, "k") for p in pages], "page_id long, url string, html string, key string"))
    out = warc.resolve(warc.captures_of(work), work, payloads=True).collect()
    assert Counter(r.page_id for r in warc.read_all(directory, work).collect()) == Counter(p[0] for p in pages)
    assert len(out) == len(pages) and Counter(r.page_id for r in out) == Counter(p[0] for p in pages)
    refers = {r.page_id: r.refers_to for r in out if r.record_type == "revisit"}
    assert refers == {big + 1: big + 2, 7: 7, None: None} and {r.url for r in out} == {"u://a/", odd, None}


def test_clashing_names_give_way(spark, rows):
    d = spark.createDataFrame([(i, t, "en", "s1", 5, "x") for i, t, *_ in rows[:14]], "doc_id long, text string, lang string, source string, n_tokens long, domain string")
    d = d.withColumns({"epoch": F.lit("e"), "email": F.lit("m"), "n_lines": F.lit("n"), "span": F.lit(1), "rest": F.lit(2), "h": F.lit(3)})
    assert all(r.domain == "code" or r.domain in ("web", "books", "reference") for r in mixing.mix(d, facts=True).collect())
    assert dict(pii.find(d).dtypes)["email"].startswith("array") and dict(line_dedup.dedup(d, full=True).dtypes)["n_lines"] == "bigint"


def test_base_spans_equal_plain_patterns(spark):
    rng = random.Random(2)
    plain = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"}
    texts = ["".join(rng.choice("a_.1@-5 ") for _ in range(rng.randrange(60))) for _ in range(1500)] + ["x" * 60_000 + " @ ", "1" * 60_000 + "."]
    found = pii.find(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    for r in found.select("doc_id", "email", "ip").collect():
        t = texts[r.doc_id]
        assert [(s.start, s.end) for s in r.email] == [m.span() for m in re.finditer(plain["email"], t)]
        assert [(s.start, s.end) for s in r.ip] == [m.span() for m in re.finditer(plain["ip"], t) if all(int(x) <= 255 for x in m[0].split("."))]


def test_pipeline_lets_emptied_documents_go(spark, rows):
    import corpus_pipeline

    d = spark.createDataFrame([r[:5] for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r.doc_id for r in corpus_pipeline.lines(spark, d, "").collect()}
    assert 7 in kept and 8 not in kept and {0, 1, 2} <= kept


@pytest.mark.parametrize(("held", "base"), [(1 << 20, 1 << 20), (64, 0), (64, 4)])
def test_induced_sort_with_queues_on_disk(tmp_path, held, base):
    rng = random.Random(held + base)
    for letters in (b"a", b"ab", b"abc", bytes(range(97, 123))):
        parts = [bytes(rng.choice(letters) for _ in range(rng.randrange(1, 80))) for _ in range(5)]
        parts.append(parts[0] + parts[1])
        text = np.frombuffer(b"\xff".join(parts) + b"\xff", np.uint8) + np.uint8(1)
        raw, pos, lcp = text.tobytes(), [], []
        induced_sort.ordered(text, 9, lambda p, x: (pos.extend(p.tolist()), lcp.extend(x.tolist())), f"file://{tmp_path}/q", held, base)  # noqa: B023
        assert pos == sorted(range(len(raw)), key=lambda i: raw[i:], reverse=True)[:-1]
        for a, b, n in zip(pos[:-1], pos[1:], lcp[1:], strict=True):
            assert raw[a : a + n] == raw[b : b + n] and (n == 9 or raw[a + n : a + n + 1] != raw[b + n : b + n + 1])


def test_line_dedup(docs, rows, empty):
    got = {r.doc_id: r for r in line_dedup.dedup(docs, full=True).collect()}
    seen = set()
    for i, t, *_ in rows:
        lines = (t or "").split("\n")
        full = [k for k, x in enumerate(lines) if re.search(WORD, x)]
        gone = set()
        for p in range(len(full) - 2):
            w = tuple(lines[k] for k in full[p : p + 3])
            if w in seen:
                gone |= set(full[p : p + 3])
            seen.add(w)
        assert got[i].n_removed == len(gone) and got[i].text == (None if t is None else "\n".join(x for k, x in enumerate(lines) if k not in gone))
    assert line_dedup.dedup(empty).count() == 0 and line_dedup.dedup(docs).columns == docs.columns


@pytest.mark.parametrize(("size", "p", "run", "tile"), [(4, 85, 64, 2048), (5, 80, 2, 4)])
def test_ngram_join(docs, rows, empty, size, p, run, tile, monkeypatch):
    monkeypatch.setattr(ngram_join.runs, "__defaults__", (run,))
    monkeypatch.setattr(ngram_join.tiles, "__defaults__", (tile,))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.classes(docs, size, p).collect()}
    sets = {}
    for i, t, *_ in rows:
        w = re.findall(WORD, re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[i] = {tuple(w[k : k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} - {()}
    near = {i: {j for j, b in sets.items() if i != j and a and b and 100 * len(a & b) >= p * len(a | b)} for i, a in sets.items()}
    for i in sets:
        reach, todo = {i}, [i]
        while todo:
            todo += (new := near[todo.pop()] - reach)
            reach |= new
        assert got[i] == (len(sets[i]), min(reach))
    assert ngram_join.classes(empty, size, p).count() == 0


def test_ngram_join_lets_only_close_pairs_leave_a_run(spark):
    # One key of forty sets, long and short: only the pair whose sketches are close may become a row.
    rng = np.random.default_rng(1)
    sets = [rng.integers(1, 1 << 63, 300 if i % 2 else 280).astype(np.uint64) for i in range(40)]
    sets[7] = np.append(sets[5][3:], sets[9][:2])
    mini = [(x := ngram_join.parity_sketch(s), ngram_join.folded(x, len(x) // 4).tobytes())[1] for s in sets]
    met = spark.createDataFrame([(1, i, len(s), bytearray(m)) for i, (s, m) in enumerate(zip(sets, mini, strict=True))], "key long, doc long, n int, mini binary")
    for most in (64, 8):
        got = ngram_join.runs(met, 1, 80, 100, most).collect()
        assert [(r.a, r.b) for r in got if r.hot is None] == ([(5, 7)] if most == 64 else []) and sorted(r.a for r in got if r.hot == 1) == list(range(40))
    alone = spark.createDataFrame([(k, d) for k in range(50) for d in range(1 + k % 2)], "key long, doc long")
    kept = {(r.key, r.doc) for r in ngram_join.meeting(alone.coalesce(1), 75).collect()}
    assert {(k, d) for k in range(1, 50, 2) for d in (0, 1)} <= kept and len(kept) <= 50 + 2 * 4


def test_components_take_more_edges(spark):
    from spanloom.llm.common import Workspace
    from spanloom.llm.components import components, joined

    rng, work = random.Random(4), Workspace(spark, "test")
    frame = lambda rows: spark.createDataFrame(rows, "a long, b long")
    first, more = ([(rng.randrange(60), rng.randrange(60)) for _ in range(n)] for n in (25, 20))
    label = components(frame(first), work, "first")
    assert joined(label, frame(first), work, "same").collect() == label.collect()
    got = {(r.node, r.component) for r in joined(label, frame(more + [(7, 99), (98, 99)]), work, "more").collect()}
    assert got == {tuple(r) for r in components(frame(first + more + [(7, 99), (98, 99)]), work, "whole").select("node", "component").collect()}


def test_sketch_distances():
    rng = np.random.default_rng(2)
    raw = [rng.bytes(8 << int(k)) for k in rng.integers(1, 4, 30)]
    a, b = rng.integers(0, 30, 200), rng.integers(0, 30, 200)
    far = [int(np.bitwise_count(ngram_join.folded(x, min(len(x), len(y))) ^ ngram_join.folded(y, min(len(x), len(y)))).sum()) for x, y in ((raw[i], raw[j]) for i, j in zip(a, b, strict=True))]
    assert ngram_join.distances(raw, a, b).tolist() == far


def test_pipeline(spark, rows, tmp_path):
    import corpus_pipeline

    spark.createDataFrame([r[:5] for r in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert out and len({r.doc_id for r in out}) <= len(rows)
    assert all(r.length <= 4096 for r in out)
