import json

import pytest
from pyspark.sql import functions as F

from spanloom.operators import adapter, answers
from spanloom.schema import SPAN
from spanloom.sources import records, sinks
from spanloom.streaming import queue

LISTS = {f"L{i}": [] for i in range(1, 8)}


def capture(texts, results, url="https://h.example/api/v1/parse?x=1"):
    return f"curl --location '{url}' \\\n--header 'A: b' \\\n--data '{json.dumps({'texts': texts})}'\n\n" + json.dumps({"results": results}, indent=1).replace('{\n "results"', '{"results"') + "\ntrailing text\n"


def test_captures(spark, tmp_path):
    ok = [{"result": LISTS | {"input": "a", "L5": ["Lê Lợi"]}, "confidence": 1}, {"result": LISTS}]
    files = {"good.txt": capture(["12 Lê Lợi", "b"], ok), "short.txt": capture(["a"], ok), "none.txt": "nothing", "nourl.txt": capture(["a", "b"], ok).replace("--location", "-L")}
    for name, content in files.items():
        (tmp_path / name).write_text(content)
    good, bad = records.captures(spark, str(tmp_path))
    rows = sorted(good.collect(), key=lambda r: r.source.batch_index)
    assert [(r.text, r.result.L5, r.source.endpoint, r.source.batch_index) for r in rows] == [("12 Lê Lợi", ["Lê Lợi"], "/api/v1/parse", 0), ("b", [], "/api/v1/parse", 1)]
    assert {r.capture: r.error for r in bad.collect()} == {"short.txt": "length", "none.txt": "request", "nourl.txt": "endpoint"}


def test_records_and_gold(spark, tmp_path):
    raw = [{"text": "Lê", "tokens": ["x"], "bio": ["O"], "len_nfc": 2}, {"input": "ab", "tokens": [], "bio": [], "len_nfc": 3}, {"input": "ab", "tokens": [], "bio": []}]
    (tmp_path / "out_model.json").write_text(json.dumps(raw))
    rows = sorted(records.normalized(records.records(spark, str(tmp_path / "out_model.json"))).collect(), key=lambda r: r.case_id)
    assert [(r.case_id, r.raw_text, r.meta.nfc_shift) for r in rows] == [("out_model#00000", "Lê", True), ("out_model#00001", "ab", True), ("out_model#00002", "ab", False)]
    (tmp_path / "clash.json").write_text(json.dumps([{"text": "a", "input": "b"}]))
    (tmp_path / "object.json").write_text('{"text": "a"}')
    for name in ("clash", "object"):
        with pytest.raises(Exception, match="differ|not an array"):
            records.normalized(records.records(spark, str(tmp_path / f"{name}.json"))).collect()
    (tmp_path / "gold.json").write_text(json.dumps({"texts": ["a", "b", "a"], "results": [{"result": LISTS | {"L1": [str(i)]}} for i in range(3)]}))
    last = records.latest(records.gold(spark, str(tmp_path / "gold.json")), "text", "index")
    assert {r.text: r.result.L1 for r in last.collect()} == {"a": ["2"], "b": ["1"]}
    (tmp_path / "lines.txt").write_text("one\n\n  \t\ntwo\n")
    assert [r.line for r in records.lines(spark, str(tmp_path / "lines.txt")).collect()] == ["one", "two"]


def test_answers(spark):
    spans = [{"start": "1", "end": 2, "level": "L1", "text": "x"}, {"start": "q", "end": 2, "level": "L1", "text": "x"}, {"level": "L9", "text": "y"}]
    said = [json.dumps({"spans": spans}), "```json\n" + json.dumps([{"spans": spans}]) + "\n```", json.dumps({"records": [{"spans": []}]}), "no", json.dumps([{"spans": []}, {"spans": []}])]
    got = spark.createDataFrame(list(enumerate(said)), "i long, a string").select("i", answers.answer_spans(F.col("a")).alias("r"), answers.entities(F.col("a")).alias("e")).orderBy("i").collect()
    assert [(len(r.r.spans), r.r.n_malformed) if r.r else None for r in got] == [(1, 2), (1, 2), (0, 0), None, None]
    assert [(e.level, e.text) for e in got[0].e] == [("L1", "x"), ("L1", "x")]
    gold = spark.createDataFrame([(json.dumps(LISTS | {"L5": ["x", "y"], "L2": ["z"]}),), ("{}",)], "j string").select(answers.gold_entities(F.from_json("j", records.RESULT))).collect()
    assert [[(e.level, e.text) for e in r[0]] for r in gold] == [[("L2", "z"), ("L5", "x"), ("L5", "y")], []]
    parts = spark.sql(f"SELECT 'ab cd' AS t, CAST(array(struct(3, 5, 'L2', 'cd', false), struct(0, 1, 'L1', 'a', false)) AS array<{SPAN}>) AS s").select(answers.highlighted(F.col("t"), F.col("s")), answers.blinded(F.col("s"))).first()
    assert [(p.text, p.level) for p in parts[0]] == [("a", "L1"), ("b ", None), ("cd", "L2")] and [p.level for p in parts[1]] == ["L1", "L2"]


def test_message_contract(spark):
    good = {"msg_id": "a#00001", "text": "t", "result": LISTS, "source": {"capture": "c", "endpoint": "/e", "batch_index": 0}, "produced_at": "2026-01-02T03:04:05+07:00"}
    bad = {"msg_id": "a#1", "text": "", "result": LISTS | {"L2": None}, "source": {"capture": "c", "endpoint": "", "batch_index": -1}, "produced_at": "2026-01-02T03:04:05"}
    shape = f"struct<msg_id:string,text:string,result:{records.RESULT},source:struct<capture:string,endpoint:string,batch_index:int>,produced_at:string>"
    msgs = spark.createDataFrame([(json.dumps(good),), (json.dumps(bad),), ("{}",)], "j string").select(F.from_json("j", shape).alias("m"))
    got = [r[0] for r in msgs.select(answers.message_errors(F.col("m"))).collect()]
    assert got[0] == [] and got[1] == ["msg_id", "text", "result.L2", "source.endpoint", "source.batch_index", "produced_at zone"] and got[2] == ["msg_id", "text", "result", "source", "produced_at"]
    sent, skipped = queue.produced(msgs, answers.message_errors(F.col("m")))
    assert (sent.count(), skipped.count()) == (1, 2)


def test_adapter(spark):
    run = lambda rule, pairs: [tuple(x) for x in spark.createDataFrame([(pairs,)], f"p {adapter.PAIRS}").select(rule(F.col("p"))).first()[0]]
    assert run(adapter.continue_words, [("th@@", "B_WARD"), ("ạnh", "O"), ("x@@", "B_WARD"), (",", "O")]) == [("th@@", "B_WARD"), ("ạnh", "I_WARD"), ("x@@", "B_WARD"), (",", "O")]
    assert run(adapter.repair_starts, [("a", "I_WARD"), ("b", "I_WARD"), ("c", "I_CITY")]) == [("a", "B_WARD"), ("b", "I_WARD"), ("c", "B_CITY")]
    assert run(adapter.absorb_prefixes, [("Quận", "O"), ("số", "O"), ("1", "B_DIST"), ("đường", "O"), ("x", "I_STREET")]) == [("Quận", "B_DIST"), ("số", "I_DIST"), ("1", "I_DIST"), ("đường", "B_STREET"), ("x", "I_STREET")]
    assert run(adapter.merge_types, [("phường", "WARD_TYPE"), ("5", "B_WARD"), ("6", "B_WARD")]) == [("phường", "B_WARD"), ("5", "I_WARD"), ("6", "B_WARD")]
    whole = lambda p: adapter.adapted(p, ["ha noi"])
    got = run(whole, [("12", "NUMBER"), ("/", "O"), ("3", "NUMBER"), ("Lê", "B_STREET"), ("Lợi", "I_STREET"), ("Hà", "B_DIST"), ("Nội", "I_DIST"), ("Việt", "B_CITY"), ("Nam", "I_CITY")])
    assert [(level, text.strip()) for level, text in got] == [("L6", "12"), ("L6", "3"), ("L5", "Lê Lợi"), ("L2", "Hà Nội"), ("L1", "Việt Nam")]


def test_queue_states(spark):
    empty = spark.createDataFrame([], "id long, topic string, run_id string, case_id string, status string, attempts int, available_at double, last_error string")
    q = queue.publish(empty, spark.createDataFrame([(i, "parse" if i < 4 else "judge", "r", f"c{i}") for i in range(1, 6)], "id long, topic string, run_id string, case_id string"))
    state = lambda d: {r.id: (r.status, r.attempts, r.available_at) for r in d.collect()}
    q = queue.claim(q, "parse", 1.0, 2).checkpoint()
    assert state(q) == {1: ("processing", 1, 0.0), 2: ("processing", 1, 0.0), 3: ("pending", 0, 0.0), 4: ("pending", 0, 0.0), 5: ("pending", 0, 0.0)}
    q = queue.settle(q, spark.createDataFrame([(1, None, True), (2, "x" * 900, True)], "id long, error string, retry boolean"), 1.0, 2, (5.0, 30.0)).checkpoint()
    assert state(q)[1][0] == "done" and state(q)[2] == ("pending", 1, 6.0) and max(len(r.last_error or "") for r in q.collect()) == 500
    assert state(queue.claim(q, "parse", 2.0, 9))[2][0] == "pending"
    q = queue.claim(q, "parse", 7.0, 9).checkpoint()
    assert state(queue.recover(q, 8.0))[2] == ("pending", 2, 8.0)
    q = queue.settle(q, spark.createDataFrame([(2, "again", True), (3, "fatal", False)], "id long, error string, retry boolean"), 7.0, 2, (5.0,))
    assert (state(q)[2][0], state(q)[3][0]) == ("failed", "failed") and {(r.topic, r.status): r.n for r in queue.counts(q).collect()}[("parse", "failed")] == 2
    cases = spark.createDataFrame([("r", "decided"), ("r", None), ("s", "decided")], "run_id string, stage string")
    assert {r.run_id: (r.open, r.done) for r in queue.open_cases(cases).collect()} == {"r": (1, False), "s": (0, True)}


def test_stage_over_a_file_stream(spark, tmp_path):
    src, out, ck = (str(tmp_path / x) for x in ("src", "out", "ck"))
    schema = "id long, text string"
    for part in (range(10), range(10, 25)):
        spark.createDataFrame([(i, f"t{i}") for i in part], schema).write.mode("append").json(src)
        queue.run_stage(spark.readStream.schema(schema).json(src), lambda d: d.withColumn("n", F.length("text")), out, ck).awaitTermination()
    got = spark.read.parquet(out).select("id", "n")
    assert got.count() == 25 and got.exceptAll(spark.read.schema(schema).json(src).select("id", F.length("text").alias("n"))).count() == 0


def test_ledger(spark, tmp_path):
    schema = "run_id string, seq long, kind string, estimate double, actual double"
    spark.createDataFrame([("r", 1, "reserve", 6.0, 0.0), ("r", 2, "reserve", 5.0, 0.0), ("r", 3, "settle", 6.0, 2.0), ("r", 4, "reserve", 5.0, 0.0), ("s", 1, "reserve", 99.0, 0.0)], schema).coalesce(1).write.json(str(tmp_path / "e"))
    seen = []
    q = queue.ledger(spark.readStream.schema(schema).json(str(tmp_path / "e")), 10.0).writeStream.outputMode("update").foreachBatch(lambda d, _: seen.extend(d.collect())).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert {r.run_id: (r.spent, r.reserved, r.accepted, r.refused) for r in seen} == {"r": (2.0, 5.0, 2, 1), "s": (0.0, 0.0, 0, 1)}


def test_sinks(spark, tmp_path):
    lines = spark.createDataFrame([("good", []), ("bad", ["short", "strange"])], "line string, why array<string>")
    sinks.write_filtered(lines, "why", str(tmp_path / "f"))
    assert [r.value for r in spark.read.text(str(tmp_path / "f/removed")).collect()] == ["bad\tshort,strange"]
    todo, path = spark.createDataFrame([(1, "a"), (2, "b")], "id long, x string"), str(tmp_path / "j")
    sinks.append_missing(todo, todo.limit(0), "id", path)
    sinks.append_missing(todo, spark.read.json(path), "id", path)
    assert spark.read.json(path).count() == 2 and sinks.heading(todo) == "| id | x |\n|-|-|"
    assert sorted(r.value for r in sinks.markdown(todo).collect()) == ["| 1 | a |", "| 2 | b |"]
