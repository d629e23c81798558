from pyspark.sql import functions as F

from spanloom import schema
from spanloom.functions import stats, text
from spanloom.operators import corpus, decisions, match, spans


def one(spark, *cols):
    return spark.range(1).select(*cols).first()


def tags(*t):
    return F.array(*map(F.lit, t))


def sp(start, end, level, words):
    return spans.span(F.lit(start), F.lit(end), F.lit(level), F.lit(words))


def test_bio_round_trip(spark):
    t = F.lit("12 Lê Lợi, Q1")
    tok, bio = tags("12", "Lê", "Lợi", ",", "Q1"), tags("B-L6", "B-L5", "I-L5", "O", "I-L3")
    got = spans.spans_from_bio(t, tok, bio)
    row = one(spark, got, spans.transition_errors(bio), spans.invalid_tags(tags("O", "X", "B-L8")))
    assert [(s.start, s.end, s.level) for s in row[0]] == [(0, 2, "L6"), (3, 9, "L5"), (11, 13, "L3")]
    assert row[1] == [4] and row[2] == [1, 2]
    a, b = spans.tokens_and_bio(t, got)
    row = one(spark, a, b)
    assert row[0] == ["12", "Lê", "Lợi", ",", "Q1"] and row[1] == ["B-L6", "B-L5", "I-L5", "O", "B-L3"]
    assert one(spark, spans.locate_tokens(t, tags("12", "Lợi")))[0] is None


def test_validator_repairs_and_reports(spark):
    v = spans.validate_spans(F.lit("a b a"), F.array(sp(0, 1, "L5", "b"), sp(3, 4, "L5", "a"), sp(0, 1, "L9", "a"), sp(0, 1, "L5", "z")))
    got = one(spark, v)[0]
    assert [(s.start, s.end) for s in got.spans] == [(2, 3)]
    assert [h.rule for h in got.hard] == ["offset_ambiguous", "level_invalid", "span_not_in_input"] and got.soft[0].rule == "offset_fixed"


def test_compare_pairs_by_overlap(spark):
    got = one(spark, match.compare(F.array(sp(0, 5, "L3", "abcde")), F.array(sp(0, 2, "L3", "ab"), sp(3, 5, "L4", "de"))))[0]
    assert [i.kind for i in got["items"]] == ["PAR", "MIS"] and got.severity_total == 1.7 and got.levels_involved == ["L3", "L4"]
    same = one(spark, match.compare(F.array(sp(0, 2, "L3", "ab")), F.array(sp(0, 2, "L3", "ab"))))[0]
    assert same.identical and same.severity_total == 0


def test_statistics(spark):
    lo, hi = stats.wilson(F.lit(5), F.lit(10))
    row = one(spark, lo, hi, stats.wilson(F.lit(0), F.lit(0))[0], stats.nearest_p95(F.transform(F.sequence(F.lit(0), F.lit(30)), lambda x: x)))
    assert 0.23 < row[0] < 0.24 and 0.76 < row[1] < 0.77 and row[2] is None and row[3] == 28
    k = decisions.kappa(spark.createDataFrame([(0, 1), (1, 0)], "a int, b int"), "a", "b").first()
    assert k.kappa == -1


def test_text(spark):
    row = one(spark, text.nfc(F.lit("é")), text.match_key(F.lit(" Hồ  Chí. ")), text.fold(F.lit("Đường Nguyễn-Huệ")), text.canon(F.lit("hoà")), text.canon(F.lit("hòa")), text.extract_json(F.lit('x ```json\n{"a":1}\n``` y')), text.extract_json(F.lit("none")))
    assert row[0] == "é" and row[1] == "hồ chí" and row[2] == "duong nguyen hue" and row[3] == row[4] and row[5] == '{"a":1}' and row[6] is None


def test_corpus_reasons(spark):
    assert one(spark, corpus.reasons(F.lit("so 5 duong phuong phuong 3 - quan mot hai")))[0] == ["orthography", "hyphen", "repeat"]


def test_gate(spark):
    rows = [(True, None), (False, None), (False, "old"), (False, "tie"), (False, "new")]
    df = spark.createDataFrame(rows, "i boolean, w string")
    got = [r[0] for r in df.select(decisions.decision(F.col("i"), F.col("w"))).collect()]
    assert got == ["agree", "inconclusive", "model_better", "tie", "deepseek_better"]


def test_tags_that_do_not_fit_their_text(spark):
    t = F.lit("ab cd")
    row = one(spark, spans.locate_tokens(t, tags("ab")), spans.spans_from_bio(t, tags("ab", "cd"), tags("O")), spans.validate_bio(t, tags("ab", "cd"), tags("O"), F.array(sp(0, 2, "L1", "ab"))), spans.islands(tags("X", "I-L1", "I-L1", "B-L1", "O")))
    assert row[0] is None and row[1] is None and row[2] == ["length_mismatch"]
    assert [(s.first, s.last, s.level) for s in row[3]] == [(1, 2, "L1"), (3, 3, "L1")]
    parse = one(spark, spans.validate_parse(t, tags("ab", "cd"), tags("B-L1", "O"), F.array(sp(9, 9, "L1", "ab"))))[0]
    assert parse.ok and [s.rule for s in parse.soft] == ["offset_repaired"] and parse.bio == []


def test_diff_counts_and_flags(spark):
    cut = spans.span(F.lit(0), F.lit(2), F.lit("L3"), F.lit("ab"), F.lit(True))
    row = one(spark, match.compare(F.array(cut), F.array(sp(0, 2, "L3", "ab")), truncation=True), match.compare(F.array(cut), F.array(sp(0, 2, "L3", "ab"))), match.compare(F.array().cast("array<" + schema.SPAN + ">"), F.array(cut)))
    assert row[0].counts.TRUNC == 1 and row[0].severity_total == 0.1 and row[1].identical and row[2].abstain == "old_empty" and row[2].counts.MIS == 1


def test_hyphens_and_abbreviations(spark):
    lines = ["12 - 34", "5 -6", "1--2", "a - 5", "7 -", "no"]
    assert [one(spark, corpus.level_hyphen(F.lit(x)))[0] for x in lines] == [False, False, True, True, True, False]
    want = {"kp, 3": "khu phố, 3", "p 12": "phường 12", "KP.3 Q.1": "Khu Phố 3 Quận 1", "12kp": "12 khu phố", "tp hcm": "thành phố hcm", "up  x": "up  x", "ở P6": "ở Phường 6"}
    for short, full in want.items():
        assert one(spark, text.expand(F.lit(short)))[0] == full, short
    assert one(spark, text.canon(F.lit("hoả")), text.canon(F.lit("hoã")))[:] == ("hoa4", "hoa3")


def test_recommendation(spark):
    limits = {"min_severity": 0.5, "min_kappa": 0.6, "max_false_alarm": 0.1, "max_flip_rate": 0.2, "min_cases": 5, "max_error_rate": 0.1}
    judge = lambda k: F.struct(F.lit(k).alias("kappa"), F.lit(0.05).alias("false_alarm"), F.lit(0.1).alias("flip_rate"), F.lit(0.5).alias("precision"))
    q = lambda k, n, low: F.struct(F.lit("L3").alias("level"), F.lit(k).alias("k"), F.lit(n).alias("n"), F.lit(k / n).alias("rate"), F.lit(low).alias("ci_low"))
    go = lambda j, a, b, lim=limits: one(spark, decisions.verified_recommendation(j, a, F.array(b), lim))[0]
    assert go(judge(0.9), q(10, 40, 0.14), q(2, 9, 0.3)).status == "retrain" and go(judge(0.9), q(10, 40, 0.14), q(6, 9, 0.3)).slices == ["L3"]
    assert go(judge(0.9), q(10, 400, 0.01), q(2, 9, 0.3)).status == "no_retrain" and go(judge(0.2), q(1, 4, 0.1), q(2, 9, 0.3)).reasons == ["kappa"]
    assert go(judge(0.9), q(10, 40, 0.14), q(2, 9, 0.3)).corrected_error_rate == 0.125
    assert go(judge(0.9), q(1, 4, 0.1), q(2, 9, 0.3), limits | {"min_kappa": None}).status == "uncalibrated"


def test_calibration(spark):
    rows = [("new", "new", False), ("new", "old", False), ("old", "old", False), (None, "new", False), ("tie", "tie", False), (None, "new", True), (None, "tie", True)]
    r = decisions.calibration(spark.createDataFrame(rows, "winner string, truth string, identical boolean")).first()
    assert (r.n_judged, r.accuracy, r.detect_precision, r.detect_recall, r.flip_rate, r.agree_but_wrong) == (5, 0.75, 0.5, 0.5, 0.2, 0.5) and r.false_alarm == 1 / 3
    assert one(spark, decisions.truth_winner(F.lit(0.5), F.lit(0.5)), decisions.truth_winner(F.lit(0.4), F.lit(0.5)))[:] == ("tie", "new")


def test_spans_that_fit_are_placed_before_repairs(spark):
    got = one(spark, spans.place_spans(F.lit("a b a"), F.array(sp(3, 4, "L5", "a"), sp(0, 1, "L5", "a"))))[0]
    assert [(s.start, s.end) for s in got.spans] == [(0, 1), (4, 5)] and not got.hard
    got = one(spark, spans.place_spans(F.lit("a b a"), F.array(sp(0, 1, "L5", "b"), sp(3, 4, "L5", "a"), sp(0, 1, "L9", "a"), sp(0, 1, "L5", "z"))))[0]
    assert [h.rule for h in got.hard] == ["level_invalid", "offset_ambiguous", "text_not_in_input"] and got.soft[0].rule == "offset_repaired"
