"""Report, decoding, bridge, evaluation, settings: small tables worked out by hand or by brute force."""

import itertools
import json
import random

import pytest
from pyspark.sql import functions as F

from spanloom.operators import bridge, decisions, decode, evaluate, match, report, sample
from spanloom.schema import SPAN
from spanloom.sources import config
from spanloom.sources.records import RESULT

LISTS = {f"L{i}": [] for i in range(1, 8)}


def test_viterbi_equals_brute_force(spark):
    labels, rng = ("O", "B-L1", "I-L1", "B-L2", "I-L2"), random.Random(5)
    ok = lambda p: all(not b.startswith("I-") or a in (f"B-{b[2:]}", b) for a, b in zip(("", *p), p, strict=False))
    rows = [[[rng.uniform(-9, 0) for _ in labels] for _ in range(n)] for n in (0, 1, 2, 3, 4, 5) for _ in range(4)]
    got = spark.createDataFrame([(r,) for r in rows], "z array<array<double>>").select(decode.viterbi(F.col("z"), labels).alias("t")).collect()
    for z, g in zip(rows, got, strict=True):
        paths = (p for p in itertools.product(labels, repeat=len(z)) if ok(p))
        assert g.t == list(max(paths, key=lambda p: sum(z[i][labels.index(x)] for i, x in enumerate(p))))


def test_decoding(spark):
    row = spark.sql("SELECT 'Số 5, Lê Lợi ' AS t, array(struct(0, 2), struct(3, 4), struct(6, 8), struct(9, 12)) AS o").select(
        decode.word_tokens(F.col("t")),
        decode.tagged_spans(F.col("t"), F.col("o").cast("array<struct<start:int,end:int>>"), F.array(*map(F.lit, ("B-L6", "I-L6", "B-L5", "I-L5"))), F.array(*map(F.lit, (0.9, 0.9, 0.1, 0.8)))),
    ).first()
    assert row[0] == ["Số", "5", ",", "Lê", "Lợi"]
    assert [(s.level, s.text, s.truncated) for s in row[1]] == [("L6", "Số 5", False), ("L5", "Lê Lợi", True)]
    cuts, u = F.array(F.lit(5), F.lit(40)), lambda x: decode.weighted_cut(F.array(F.lit(5), F.lit(40)), F.lit(x))
    assert list(spark.range(1).select(u(0.0), u(0.8), u(0.95), decode.weighted_cut(F.filter(cuts, lambda c: c > 99), F.lit(0.5))).first()) == [5, 5, 40, None]


def test_bridge(spark):
    msgs = [
        {"msg_id": "a#00001", "text": "12 Lê Lợi, Lê Lợi", "result": LISTS | {"L5": ["Lê Lợi", "Lê"], "L6": ["12", "99"]}},
        {"msg_id": "a#00002", "text": "Bến  Nghé", "result": LISTS | {"L4": ["Bến Nghé"], "L2": [""]}},
        {"msg_id": "a#00003", "text": "a", "result": None},
    ]
    rows = spark.createDataFrame([(json.dumps(m),) for m in msgs], "j string").select(F.from_json("j", f"struct<msg_id:string,text:string,result:{RESULT}>").alias("m")).select("m.*")
    built = bridge.cases(rows)
    got = {r.case_id: r for r in built.collect()}
    places = lambda r: [(s.start, s.end, s.level) for s in r.old.spans]
    assert places(got["a#00001"]) == [(0, 2, "L6"), (3, 9, "L5"), (11, 13, "L5")] and [u.text for u in got["a#00001"].meta.unlocated] == ["99"]
    assert got["a#00001"].old.bio == ["B-L6", "B-L5", "I-L5", "O", "B-L5", "O"]
    two = got["a#00002"]
    assert places(two) == [(0, 9, "L4")] and two.old.spans[0].text == "Bến  Nghé" and [x.text for x in two.meta.loose_ws_match] == ["Bến Nghé"]
    assert two.meta.nfc_shift == (two.raw_text != msgs[1]["text"]) and [u.text for u in two.meta.unlocated] == [""] and got["a#00003"].old.spans == []
    assert tuple(bridge.totals(built).first()) == (3, 4, 2, 1)
    assert bridge.locate("aaa", [("L1", "aa"), ("L2", "aa")])["unlocated"] == [{"level": "L2", "text": "aa"}]


def span(a, b, level="L3"):
    return (a, b, level, "x" * (b - a), False)


def test_report(spark):
    call = lambda raw: (raw, 0.5, 1.0)
    cases = [
        ("agree", False, True, [span(0, 1)], [span(0, 1)], None),
        ("deepseek_better", True, False, [span(0, 1)], [span(0, 1), span(2, 3, "L4")], [call("2"), call("1")]),
        ("deepseek_better", False, False, [span(0, 1)], [span(0, 1, "L5")], [call("2"), call("1")]),
        ("model_better", False, False, [span(0, 1), span(2, 3)], [], [call("1"), call("2")]),
        ("tie", False, False, [span(0, 1)], [span(0, 2)], [call("tie"), call("tie")]),
        ("inconclusive", False, False, [span(0, 1)], [span(4, 5)], [call("1"), call("1")]),
        (None, None, True, [span(0, 1)], None, None),
    ]
    schema = f"decision string, confirmed boolean, audit boolean, old array<{SPAN}>, new array<{SPAN}>, calls array<struct<raw:string,cost:double,elapsed:double>>"
    d = spark.createDataFrame(cases, schema).withColumn("parse_calls", F.lit(None).cast("array<struct<raw:string,cost:double,elapsed:double>>"))
    d = d.withColumn("diff", F.when(F.col("new").isNotNull(), match.compare(F.col("old"), F.col("new"))))
    metrics = report.run_metrics(d)
    m = {(r.section, r.key): r for r in metrics.collect()}
    kn = lambda s, k: (m[s, k].k, m[s, k].n)
    assert kn("decision", "open") == (1, None) and kn("audit", "flagged") == (2, 7) and kn("agreement", "identical") == (1, 6)
    assert (m["spans", "all"].k, m["spans", "all"].n, m["spans", "all"].m) == (2, 7, 6) and m["spans", "L5"].precision is None and ("spans", "L1") not in m
    assert kn("judge", "flip_rate") == (1, 5) and kn("judge", "tie_rate") == (1, 5) and kn("judge", "first_slot_win_rate") == (5, 8) and kn("judge", "winner_has_more_spans_rate") == (2, 2)
    assert kn("quality", "deepseek_better") == (2, 6) and kn("quality", "confirmed_error") == (1, 6)
    assert kn("level_rate", "L4") == (1, 6) and kn("level_rate", "L3") == (1, 6) and ("level_rate", "L7") not in m
    assert {k: v.k for (s, k), v in m.items() if s == "error_kind"} == {"MIS": 1, "INC": 1} and m["cost", "judge"].usd == 5.0
    one = report.quality_of(metrics).first()
    assert (one.quality.k, one.quality.n) == (1, 6) and [x.level for x in one.by_level] == ["L3", "L4", "L5"]
    judge = F.struct(F.lit(0.9).alias("kappa"), F.lit(0.0).alias("false_alarm"), F.lit(0.0).alias("flip_rate"), F.lit(0.5).alias("precision"))
    limits = {"min_severity": 1, "min_kappa": 0.6, "max_false_alarm": 0.1, "max_flip_rate": 0.2, "min_cases": 1, "max_error_rate": 0.02}
    said = report.quality_of(metrics).select(decisions.verified_recommendation(judge, F.col("quality"), F.col("by_level"), limits)).first()[0]
    assert said.status == "retrain" and said.slices == ["L3", "L4", "L5"] and abs(said.corrected_error_rate - 1 / 12) < 1e-12
    empty = {(r.section, r.key) for r in report.run_metrics(d.limit(0)).collect()}
    assert empty == set()


def test_report_parts(spark):
    cases = spark.createDataFrame([(f"c{i}", "t", [], i != 2) for i in range(8)], "case_id string, text string, spans array<int>, ok boolean")
    p = report.preview(cases, 3, 0.003, 0.012, 2.0).first()
    assert (p.n_cases, p.skipped, p.n_hard, p.estimate.total_max_usd) == (8, 3, 1, 0.216) and [x.case_id for x in p["sample"]] == ["c0", "c1", "c2", "c3", "c4"]
    msgs = spark.createDataFrame([("r", "parse", "failed"), ("r", "parse", "done"), ("r", "judge", "processing")], "run_id string, topic string, status string")
    stages = spark.createDataFrame([("r", "decided"), ("r", "decided"), ("r", "new")], "run_id string, stage string")
    assert {tuple(r) for r in report.progress(msgs, stages).collect()} == {("r", "stage", "decided", 2), ("r", "stage", "new", 1), ("r", "failed", "parse", 1), ("r", "processing", "judge", 1)}
    calls = spark.createDataFrame([(10, 90, 100, 5, True), (0, 50, None, None, False), (None, 100, 50, None, False)], "hit int, miss int, out int, reasoning int, peak boolean")
    price = F.struct(F.lit(1.0).alias("miss"), F.lit(0.1).alias("hit"), F.lit(2.0).alias("out"))
    b = report.billed(calls, price, F.col("peak")).first()
    assert (b.billed_calls, b.peak_calls, b.hit_tokens, b.miss_tokens, b.out_tokens) == (2, 1, 10, 190, 150) and abs(b.total_usd - (2 * 291 + 200) / 1e6) < 1e-12
    row = spark.range(1).select(report.usd(F.lit(1.5)), report.percent(F.lit(0.125)), report.percent(F.lit(None).cast("double")), report.interval(F.lit(0.1), F.lit(0.2))).first()
    assert tuple(row) == ("$1.5000", "12.5%", "-", "[10.0%, 20.0%]")


def test_evaluation(spark):
    e = lambda *x: [tuple(p.split()) for p in x]
    rows = spark.createDataFrame([(e("L1 a", "L2 b"), e("L1 a"), e("L1 a", "L2 b")), (e("L2 c"), e("L2 d"), None)], "ref array<struct<level:string,text:string>>, x array<struct<level:string,text:string>>, y array<struct<level:string,text:string>>")
    got = {r.level: tuple(r)[1:] for r in evaluate.three_way(rows).collect()}
    assert got == {"all": (3, 1, 2, 1, 2, 2, 0, 1), "L1": (1, 1, 1, 1, 1, 1, 0, 0), "L2": (2, 0, 1, 0, 1, 1, 0, 0)}
    schema = "i int, group string, tokens array<string>, label_ids array<int>, probs array<array<double>>, special array<boolean>"
    base = [(0, "full", ["<s>", "a", "b"], [0, 1, 0], [[1.0, 0.0], [0.2, 0.8], [0.9, 0.1]], [True, False, False])]
    other = [(0, "full", ["<s>", "a", "b"], [0, 1, 1], [[0.0, 1.0], [0.3, 0.7], [0.4, 0.6]], [True, False, False])]
    frames = [spark.createDataFrame(x, schema) for x in (base, other)]
    d = evaluate.drift(*frames, "i").first()
    assert (d.total, d.matches, d.rate) == (2, 1, 0.5) and abs(d.mean_diff - 0.3) < 1e-9 and abs(d.max_diff - 0.5) < 1e-9
    with pytest.raises(Exception, match="tokens differs"):
        evaluate.drift(frames[0], frames[1].withColumn("tokens", F.array(F.lit("z"))), "i").collect()
    pair = f"text string, a array<{SPAN}>, b array<{SPAN}>"
    cover = evaluate.coverage(spark.createDataFrame([("a, b", [span(0, 4)], [span(0, 1), span(3, 4)]), ("a, b", [span(0, 1)], [span(3, 4, "L4")]), ("x", [], [])], pair))
    assert {r.level: tuple(r)[1:] for r in cover.collect()} == {"L3": (2, 1, 2, 1), "L4": (1, 0, 0, 1), "any": (3, 2, 2, 2)}
    rows = spark.createDataFrame([(["O", "B-L3"], [span(0, 1)], ["O", "O"], [span(0, 1), span(2, 3)])], f"bio array<string>, spans array<{SPAN}>, bio_gold array<string>, spans_gold array<{SPAN}>")
    got = {r.part: (r.tp, r.n_pred, r.n_gold, r.r) for r in evaluate.tagger_scores(rows).collect()}
    assert got == {"tokens": (1, 2, 2, 0.5), "rows": (0, 1, 1, 0.0), "spans": (1, 1, 2, 0.5), "truncated": (0, 0, 0, 0.0), "L3": (1, 1, 2, 0.5)}
    probes = evaluate.probe_scores(spark.createDataFrame([("known", "good", "good"), ("known", "good", "other"), ("identical", "tie", "tie"), ("identical", "good", "good"), ("verbose", None, None)], "kind string, first string, second string"))
    calls = spark.createDataFrame([("identical", "1", 1, 2.0, 0.1, None), ("identical", "tie", 2, 4.0, 0.1, None), ("known", None, None, None, 0.0, "x")], "kind string, raw string, attempts int, elapsed double, cost double, error string")
    by, one = evaluate.probe_summary(probes, calls)
    assert {tuple(r) for r in by.collect()} == {("known", 2, 1, 1), ("identical", 2, 1, 0), ("verbose", 1, 0, 1)}
    assert one.first().asDict() == {"picks_1": 1, "picks_2": 0, "picks_tie": 1, "errors": 1, "retried": 1, "latency_mean": 3.0, "latency_p95": 4.0, "cost_usd": 0.2}


def test_dataset_rows(spark):
    cut = (0, 1, "L7", "a", True)
    rows = spark.createDataFrame([("a, b", [span(0, 1)], True, 1, "x"), ("A", [], False, 1, "x"), ("ab", [cut], False, 2, "y")], f"text string, spans array<{SPAN}>, is_full boolean, source_id int, group string")
    one, names = evaluate.dataset_stats(rows)
    o = one.first()
    assert (o["rows"], o.full, o.prefix, o.source_ids, o.full_lowercase, o.full_no_comma, o.prefix_truncated, o.prefix_no_span) == (3, 1, 2, 2, 1.0, 0.0, 0.5, 0.5)
    assert {tuple(r) for r in names.collect()} == {("group", "x", 2), ("group", "y", 1), ("level", "L3", 1), ("level", "L7", 1)}
    bad = spark.createDataFrame([("ab", ["ab"], ["O"], [(0, 1, "L1", "a", True), (0, 2, "L2", "zz", False)]), ("ab", ["ab"], [], [])], f"text string, tokens array<string>, bio array<string>, spans array<{SPAN}>")
    assert [r[0] for r in bad.select(evaluate.row_errors(*map(F.col, ("text", "tokens", "bio", "spans")))).collect()] == [["span_text", "overlap", "truncated"], ["length"]]


def test_sampling_parts(spark):
    d = spark.range(100).withColumn("g", F.col("id") % 7)
    parts = sample.halves(d, "id", 10, 1).collect()
    assert [sum(r.part == k for r in parts) for k in (0, 1)] == [10, 10] and len({r.id for r in parts}) == 20
    held = sample.split_held_out(d, "g", F.col("id") == 3, 0.0, 1)
    assert [r.id for r in held.filter("split = 'test'").collect()] == [3]
    fresh = sample.unseen(spark.createDataFrame([("a",), ("a",), ("b",), ("c",), (None,)], "k string"), "k", spark.createDataFrame([("b",)], "k string"), spark.createDataFrame([("z",)], "k string"))
    assert sorted(r.k for r in fresh.collect()) == ["a", "c"]
    assert sample.require_disjoint(sample.split(d, "g", 0.5, 1), "g", "split").count() == 100
    with pytest.raises(Exception, match="in several parts"):
        sample.require_disjoint(held, "g", "split").count()


def test_settings(tmp_path, monkeypatch):
    path = lambda name, text: (tmp_path / name).write_text(text, encoding="utf-8") and str(tmp_path / name)
    monkeypatch.setenv("B", "mine")
    assert config.settings(str(tmp_path / "none")) == {}
    env = config.environment(path(".env", "A='x y'\n# C=1\nexport B=file\nbad line\n"))
    assert env["A"] == "x y" and env["B"] == "mine" and "C" not in env
    path("01.txt", " one \n"), path("02.txt", "two")
    text, digest = config.prompt(str(tmp_path), ["01.txt", "02.txt", "09.txt"], ("09.txt",))
    assert text == "one\n\n---\n\ntwo\n" and len(digest) == 8
    with pytest.raises(FileNotFoundError):
        config.prompt(str(tmp_path), ["01.txt", "03.txt"])
    assert config.task_prompt(path("t.txt", "# head\n# more\n\nbody # not head\n"))[0] == "body # not head"
    assert config.fingerprint({"a": 1, "b": 2}) == config.fingerprint({"b": 2, "a": 1})
    file = path("thresholds.json", '{"version": 4, "min_severity": null}')
    assert config.write_threshold(file, "min_severity", 0.5) == config.settings(file) == {"version": 5, "min_severity": 0.5}
    assert config.run_facts("abc", str(tmp_path))["commit"] is None
