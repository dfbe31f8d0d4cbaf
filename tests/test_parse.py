import json

from conftest import ms, rows
from pyspark.sql import functions as F

from tradepulse import schemas as S
from tradepulse.operators import logsplit, parse
from tradepulse.sources import topics


def texts(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def log(ts=1, **parts):
    return json.dumps({"common": {"mid": "m", "uid": "u", "is_new": "0"}, "ts": ts, **parts})


def test_quarantine_takes_everything_that_is_no_object(spark):
    raw = texts(spark, log(page={"page_id": "home"}), "not json", "", '{"ts": "soon"}', "null", '{"ts": 5')
    parsed = parse.parse_with_quarantine(raw, S.LOG)
    assert rows(parse.bad_rows(parsed)) == sorted([("",), ("not json",), ("null",), ('{"ts": "soon"}',), ('{"ts": 5',)],
                                                  key=str)
    assert parse.good_rows(parsed).count() == 1


def test_text_is_parsed_once_whatever_filters_follow(spark):
    plan = parse.behaviour_logs(parse.parse_json(texts(spark, ""), S.LOG))._jdf.queryExecution().optimizedPlan()
    assert plan.toString().count("from_json") == 1


def test_behaviour_logs_need_page_or_start_and_a_device(spark):
    raw = texts(spark, log(page={"page_id": "a"}), log(start={"entry": "b"}), log(),
                json.dumps({"common": {"uid": "u"}, "page": {}, "ts": 1}))
    assert parse.behaviour_logs(parse.parse_json(raw, S.LOG)).count() == 2


def test_login_visits(spark):
    raw = texts(spark, log(page={"page_id": "a"}), log(page={"last_page_id": "login"}),
                log(page={"last_page_id": "home"}), json.dumps({"common": {"mid": "m"}, "page": {}, "ts": 1}))
    assert parse.login_visits(parse.parse_json(raw, S.PAGE)).count() == 2


def test_row_changes_drop_markers_and_empty_data(spark):
    def change(database, kind, data):
        return json.dumps({"database": database, "table": "t", "type": kind, "data": data, "ts": 1})

    raw = texts(spark, change("shop", "insert", {"id": 1}), change("shop", "bootstrap-start", {"id": 1}),
                change("shop", "bootstrap-insert", {"id": 2}), change("shop", "insert", {}),
                change("other", "insert", {"id": 3}), change("shop", "bootstrap-complete", None), "broken")
    kept = parse.row_changes(topics.change_envelope(raw), "shop")
    assert rows(kept.select(F.col("data")["id"])) == [("1",), ("2",)]


def test_registrations_leave_unreadable_times(spark):
    raw = texts(spark, '{"id":"1","create_time":"2024-01-01 00:00:05"}', '{"id":"2","create_time":"yesterday"}',
                '{"id":"3"}', '{"create_time":"2024-01-01 00:00:05"}')
    assert rows(parse.registrations(parse.parse_json(raw, S.strings("id", "create_time"))), "id") == [("1",)]


def test_split_outputs(spark):
    raw = texts(
        spark,
        log(1, page={"page_id": "a"}, err={"code": 7}, displays=[{"item": "x"}, {"item": "y"}], actions=[{"act": "z"}]),
        log(2, page={"page_id": "b"}, start={"entry": "icon"}, displays=[{"item": "never"}]),
        log(3, start={"entry": "icon"}, err={"code": 8}), log(4, page={"page_id": "c"}, displays=[]))
    out = {n: [json.loads(r.value) for r in logsplit.as_json(n, df).collect()]
           for n, df in logsplit.split(parse.behaviour_logs(parse.parse_json(raw, S.LOG))).items()}
    assert sorted(e["code"] for e in out["err"]) == ["7", "8"]
    assert sorted(s["ts"] for s in out["start"]) == [2, 3]
    assert sorted((d["item"], d["ts"], d["page"]["page_id"]) for d in out["display"]) == [("x", 1, "a"), ("y", 1, "a")]
    assert [(a["act"], a["common"]["mid"]) for a in out["action"]] == [("z", "m")]
    assert sorted(p["ts"] for p in out["page"]) == [1, 4]
    assert all("displays" not in p and "actions" not in p for p in out["page"])
    assert [p["err"]["code"] for p in out["page"] if p["ts"] == 1] == ["7"]


def test_fact_reread_drops_deletions(spark):
    raw = topics.non_null_text(texts(spark, '{"id":"1","ts":60}', None, '{"id":"2","ts":61}'))
    assert rows(topics.fact_reread(raw, S.ORDER_DETAIL), "id", "ts") == [("1", 60), ("2", 61)]


def test_page_log_time(spark):
    raw = texts(spark, log(ms("2024-01-01T00:00:01.250"), page={"page_id": "a"}))
    assert str(topics.page_log(raw).first().row_time) == "2024-01-01 00:00:01.250000"


def test_split_texts_name_nothing_twice(spark):
    """An action with fields called like its context: the context's values win, once."""
    rows_ = spark.createDataFrame([({"action_id": "x", "ts": "5", "page": "p"}, {"mid": "m"}, {"page_id": "home"}, 99)],
                                  "action map<string,string>, common map<string,string>, page map<string,string>, ts bigint")
    text = logsplit.as_json("action", rows_).first().value
    pairs = json.loads(text, object_pairs_hook=lambda p: p)
    assert sorted(k for k, _ in pairs) == ["action_id", "common", "page", "ts"] and dict(pairs)["ts"] == 99
