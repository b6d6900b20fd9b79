import json

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from checks import fixtures as X
from passagemill import schemas as S
from passagemill.operators import generate as G
from passagemill.operators import pairs as P
from passagemill.plans import generation, pairs
from passagemill.sources import sinks
from passagemill.sources.scratch import scratch_path
from passagemill.streaming import ingest


def line(spark, model="m", params=None, **options):
    column = P.request_line(F.lit("1__a"), F.lit('say "x" {\n}'), model, params, **options)
    return json.loads(spark.range(1).select(column).first()[0])


def test_request_body(spark):
    task = line(spark, params={"temperature": 0.5, "stop": None, "nested": {"b": [1, True], "a": "é"}})
    assert task["custom_id"] == "1__a" and task["method"] == "POST" and task["url"] == "/v1/chat/completions"
    body = task["body"]
    assert body["messages"] == [{"role": "user", "content": 'say "x" {\n}'}]
    assert body["temperature"] == 0.5 and body["stop"] is None and body["nested"] == {"b": [1, True], "a": "é"}
    assert body["response_format"]["json_schema"]["schema"]["required"] == ["question"]


def test_request_overrides(spark):
    assert line(spark, params={"model": "other"})["body"]["model"] == "other"
    for model in ("o3", "o3-mini", "o1", "o1-mini"):
        assert "temperature" not in line(spark, model, {"temperature": 1})["body"]
    with pytest.raises(ValueError):
        line(spark, "o3")


def test_requests_leave_out_empty_passages(spark):
    rows = [(1, "a"), (2, None), (None, "b")]
    df = spark.createDataFrame(rows, "id INT, t STRING")
    requests = pairs.build_requests(df, ["id"], "t", "Q {text}", "m")
    assert [(r.shard, r.custom_id, r.prompt) for r in requests.collect()] == [("shard-000", "1", "Q a")]
    assert pairs.request_rejects(df, ["id"], "t").count() == 2
    assert tuple(P.input_token_total(requests).first()) == (2, 1)
    assert tuple(P.input_token_total(requests.limit(0)).first()) == (0, 0)


def response(custom_id, content=None, tokens=None, error=None, **other):
    body = {"choices": [{"message": {"content": content}}], "usage": {"completion_tokens": tokens}}
    return json.dumps({"custom_id": custom_id, "error": error, "response": {"body": body}, **other})


LINES = [
    response("1__a", '{"question": "q1"}', 5),
    response("2__b", "```json\n{\"question\": \"\"}\n```"),
    response("3__c", '{"question": null}', 1),
    response("4__d", "nothing"),
    response("x__e", '{"question": "q"}'),
    response("1__a", '{"question": "again"}', 2),
    json.dumps({"custom_id": "6__f", "response": {"body": {"choices": []}}}),
    json.dumps({"custom_id": "7__g", "response": None, "error": {"code": 1}}),
    "broken",
]


def test_training_pairs(spark):
    lines = spark.createDataFrame([(v,) for v in LINES], "value STRING")
    rows = [(1, "a", "t1"), (2, "b", "t2"), (3, "c", "t3"), (4, "d", "t4"), (9, "z", "t9")]
    source = spark.createDataFrame(rows, "id BIGINT, part STRING, text STRING")
    counted = Observation()
    result = pairs.build_training_pairs(source, lines, ["id", "part"], counted=counted)
    got = sorted(map(tuple, result.collect()))
    assert got == [(1, "a", "t1", "again"), (1, "a", "t1", "q1"), (2, "b", "t2", "")]
    assert counted.get == {"rows": 5, "dropped": 2}
    assert P.completion_token_total(P.response_message(lines)).first()[0] == 8
    assert {r.id for r in pairs.response_rejects(lines, ["id", "part"]).collect()} == {"3", "4"}
    fields = P.response_fields(lines, S.QUESTION)
    assert ("q1", "1__a") in [tuple(r) for r in fields.collect()]
    assert "7__g" not in [r.custom_id for r in fields.collect()]


def test_incomplete_rows(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), "b"), (None, "c"), (2.0, None), (3.0, "")], "x DOUBLE, s STRING")
    assert [r.x for r in P.drop_incomplete(df).collect()] == [1.0, 3.0]


def test_errors_as_json_sees_them(spark):
    df = spark.createDataFrame([(e,) for e in (None, "", "false", "0", "x", '{"code":1}')], "error STRING")
    assert P.drop_errors(df).count() == 4


def test_two_hop_verdicts(spark):
    rows = [("abcdef", "abc", "def"), ("abcdef", "abc", "cd"), ("abcdef", "abc", "zz"), ("abcdef", "", "abc"), ("abab", "ab", "ab")]
    df = spark.createDataFrame(rows, "t STRING, chunk1 STRING, chunk2 STRING")
    assert [r.verdict for r in P.two_hop_report(df, "t").collect()] == [
        "ok", "overlap", "missing chunk", "missing chunk", "overlap",
    ]


# --- Generation -----------------------------------------------------------------------------------


def failing_twice_factory(folder):
    """A client that writes down every call; prompts with "bad" fail."""

    def factory():
        def client(prompt):
            import os
            import uuid

            open(os.path.join(folder, uuid.uuid4().hex), "w").close()
            if "bad" in prompt:
                raise ValueError("no answer")
            return {"content": '{"question": "Q %s"}' % prompt, "latency": 1.239}

        return client

    return factory


@pytest.fixture
def passages(spark):
    rows = [(1, "one"), (2, "bad two"), (3, "three")]
    return spark.createDataFrame(rows, "id BIGINT, text STRING")


def test_generation_resumes(spark, passages, tmp_path):
    cache = scratch_path(spark, "cache")
    args = (["id"], "text", "{text}", failing_twice_factory(str(tmp_path)), cache)
    result = generation.run_generation(passages.filter("id < 3"), *args)
    assert sorted(map(tuple, result.collect())) == [(1, "one", "Q one"), (2, "bad two", None)]
    result = generation.run_generation(passages, *args, workers=2, rounds=2)
    assert sorted(r.id for r in result.collect()) == [1, 2, 3]
    assert len(list(tmp_path.iterdir())) == 3  # nothing was asked twice, not even the failure
    result = generation.run_generation(passages, *args, retry_errors=True)
    assert len(list(tmp_path.iterdir())) == 4
    assert sorted(r.id for r in result.collect()) == [1, 2, 3]
    rows = spark.read.parquet(cache)
    assert rows.count() == 4 and G.one_per_key(rows, ["id"]).count() == 3
    good = rows.filter("raw.id = 1").first()
    assert (good.latency, good.reasoning_tokens, good.error, good.input_tokens) == (1.24, 0, None, 0)
    assert len(good.date) == 16
    assert rows.schema == generation.cache_schema(passages, S.QUESTION) or rows.columns == [
        f.name for f in generation.cache_schema(passages, S.QUESTION)
    ]


def test_generation_after_a_retry_and_without_nulls(spark, tmp_path):
    """A failure that a retry made good is gone from the final table; nulls are never sent."""
    folder = str(tmp_path)

    def factory():
        def client(prompt):
            import os

            assert prompt is not None
            name = os.path.join(folder, prompt.replace(" ", "_"))
            if "bad" in prompt and not os.path.exists(name):
                open(name, "w").close()
                raise ValueError("no answer")
            return {"content": '{"question": "Q %s"}' % prompt, "latency": 1.0}

        return client

    cache = scratch_path(spark, "cache")
    rows = [(1, "one"), (2, "bad two"), (None, "no id"), (4, None), (5, "five"), (5, "five again")]
    passages = spark.createDataFrame(rows, "id BIGINT, text STRING")
    args = (["id"], "text", "{text}", factory, cache)
    first = set(map(tuple, generation.run_generation(passages, *args).collect()))
    good = {(1, "one", "Q one"), (5, "five", "Q five"), (5, "five again", "Q five again")}
    assert first == good | {(2, "bad two", None)}
    second = generation.run_generation(passages, *args, retry_errors=True).collect()
    assert len(second) == 4 and set(map(tuple, second)) == good | {(2, "bad two", "Q bad two")}


def test_rejects_name_every_unused_response(spark):
    def line(key, content):
        return json.dumps({"custom_id": key, "response": {"body": {"choices": [{"message": {"content": content}}]}}})

    rows = [line("1", '{"question": "Q"}'), line("x", '{"question": "Q"}'), line("9", '{"question": "Q"}'), line("2", '{"question": null}')]
    rows += [json.dumps({"custom_id": "1", "response": {"body": {"choices": []}}}), rows[0][:20], line("2", '{"question": " "}')]
    source = spark.createDataFrame([(1, "one"), (2, "two")], "id BIGINT, text STRING")
    lines = spark.createDataFrame([(r,) for r in rows], "value STRING")
    path = scratch_path(spark, "rejects")
    made = pairs.build_training_pairs(source, lines, ["id"], rejects_path=path, drop_blank=True)
    assert [tuple(r) for r in made.collect()] == [(1, "one", "Q")]
    found = {r.value: r.reason for r in spark.read.parquet(path).collect()}
    assert [found.get(r) for r in rows] == [
        None, "id does not fit", "no passage", "no question", "no choice", "malformed", None,
    ]


def test_generation_over_a_stored_sample(spark, passages, tmp_path):
    cache, sample = scratch_path(spark, "cache"), scratch_path(spark, "sample")
    args = (["id"], "text", "{text}", failing_twice_factory(str(tmp_path)), cache)
    for seed in (1, 2):
        result = generation.run_generation(passages, *args, sample_path=sample, seed=seed, size=2)
    assert result.count() == 2 and len(list(tmp_path.iterdir())) == 2


def test_generation_of_named_schema_to_csv(spark, passages, tmp_path):
    cache, path = scratch_path(spark, "cache"), scratch_path(spark, "csv")
    args = (["id"], "text", "{text}", failing_twice_factory(str(tmp_path)), cache)
    generation.run_generation(passages, *args, seed=3, size=1, answer="TwoHopQueryGeneration", path=path)
    written = spark.read.csv(path, header=True)
    assert written.columns == ["id", "text", "question", "chunk1", "chunk2"] and written.count() == 1
    with pytest.raises(ValueError, match="unknown answer schema"):
        generation.run_generation(passages, *args, answer="Other")


def test_unreadable_answer_is_empty_and_failure_is_null(spark, passages):
    def factory():
        return lambda prompt: {"content": "no json"} if "one" in prompt else 1 / 0

    rows = generation.generated(passages, "text", "{text}", factory, S.TWO_HOP).orderBy("raw.id").collect()
    assert (rows[0].question, rows[0].chunk1, rows[0].error) == ("", "", None)
    assert rows[1].question is None and rows[1].error == "division by zero"


def test_generate_stream_resumes(spark, passages, tmp_path):
    folder, cache, marks = (scratch_path(spark, n) for n in ("in", "cache", "marks"))
    for part in ("id < 3", "id > 1"):
        passages.filter(part).coalesce(1).write.mode("append").parquet(folder)
        source = spark.readStream.schema(passages.schema).parquet(folder)
        factory = failing_twice_factory(str(tmp_path))
        ingest.generate_stream(source, ["id"], "text", "{text}", factory, cache, marks).awaitTermination()
    assert spark.read.parquet(cache).count() == 3 and len(list(tmp_path.iterdir())) == 3


def test_stream_asks_again_after_the_delay(spark, tmp_path):
    """A failing passage is asked at most three times, no sooner than the delay, over restarts and repeats."""
    import time

    folder, cache, marks, calls = scratch_path(spark, "in"), scratch_path(spark, "cache"), scratch_path(spark, "marks"), tmp_path / "calls"
    calls.mkdir()
    passages = spark.createDataFrame([(1, "one"), (2, "bad"), (3, "late"), (None, "x"), (4, None)], "id BIGINT, text STRING")
    passages.coalesce(1).write.parquet(folder)

    def factory():
        def client(prompt):
            import pathlib
            import time
            import uuid

            (calls / f"{prompt}-{time.time()}-{uuid.uuid4().hex}").touch()
            if prompt == "bad" or (prompt == "late" and len(list(calls.glob("late-*"))) < 2):
                raise ValueError("no answer")
            return {"content": '{"question": "Q %s"}' % prompt}

        return client

    def run(**more):
        source = spark.readStream.schema(passages.schema).parquet(folder)
        return ingest.generate_stream(source, ["id"], "text", "{text}", factory, cache, marks, attempts=3, retry_after=2.0, **more)

    def times(prompt):
        return sorted(float(p.name.split("-")[1]) for p in calls.glob(f"{prompt}-*"))

    run().awaitTermination()
    assert [len(times(p)) for p in ("one", "bad", "late")] == [1, 1, 1]
    run().awaitTermination()  # reads the failures; they may not be due yet
    query = run(every="0 seconds")  # a stream that goes on: its timers fire without new input
    start = time.time()
    while time.time() - start < 60 and not (len(times("bad")) == 3 and len(times("late")) == 2 and not query.status["isTriggerActive"] and time.time() - times("bad")[-1] > 4):
        time.sleep(0.2)
    query.stop()
    run().awaitTermination()
    assert [len(times(p)) for p in ("one", "bad", "late")] == [1, 3, 2]
    for prompt in ("bad", "late"):
        at = times(prompt)
        assert all(b - a >= 2.0 for a, b in zip(at, at[1:]))
    rows = spark.read.parquet(cache)
    assert sorted((r.raw.id, r.question) for r in G.settled(rows, ["id"]).collect()) == [(1, "Q one"), (2, None), (3, "Q late")]


def overlaps(folder):
    """The most calls that ran at once, from files named by start and end."""
    marks = sorted(x for p in folder.iterdir() for x in ((float(p.name.split("_")[0]), 1), (float(p.name.split("_")[1]), -1)))
    most = now = 0
    for _, step in marks:
        now += step
        most = max(most, now)
    return most


@pytest.mark.parametrize("workers,parts", [(3, 16), (6, 1)])
def test_calls_at_once_do_not_hang_on_partitions(spark, tmp_path, workers, parts):
    """At most ``workers`` calls run on the executor, over many tasks or in one; a slow call holds up no other."""

    def factory():
        def client(prompt):
            import time

            start = time.time()
            time.sleep(1.5 if prompt == "7" else 0.03)
            (tmp_path / f"{start}_{time.time()}_{prompt}").touch()
            if prompt == "9":
                raise ValueError("nine")
            return {"content": prompt}

        return client

    df = spark.range(80).selectExpr("id", "cast(id as string) as prompt").repartition(parts)
    assert G.generate(df, factory, workers=workers).rdd.getNumPartitions() == parts
    rows = G.generate(df, factory, workers=workers).collect()
    assert sorted((r.id, r.content, r.error) for r in rows) == [(i, None if i == 9 else f'"{i}"', "nine" if i == 9 else None) for i in range(80)]
    assert 2 <= overlaps(tmp_path) <= workers
    slow = next(p for p in tmp_path.iterdir() if p.name.endswith("_7"))
    low, high = (float(x) for x in slow.name.split("_")[:2])
    during = [p for p in tmp_path.iterdir() if low < float(p.name.split("_")[1]) < high]
    assert len(during) >= 20


def test_mended_text_settles_a_failure(spark):
    cache = spark.createDataFrame([((1, "bad"), None, "e"), ((1, "mended"), "Q", None), ((2, "x"), None, "e"), ((2, "x"), None, "f")], "raw STRUCT<id: INT, text: STRING>, question STRING, error STRING")
    cache = cache.selectExpr("question", "raw", "cast(null as string) as raw_response", "'d' as date", "error")
    left = sorted((r.raw.id, r.raw.text, r.question) for r in G.settled(cache, ["id"], "text").collect())
    assert left == [(1, "mended", "Q"), (2, "x", None)]


def test_telemetry(spark):
    rows = [("2024-01-01 10:00", 1, 2, 1.0, None, "m"), ("2024-01-01 11:00", 3, 4, 3.0, "x", "m"), ("2024-01-01 11:00", 3, 4, 5.0, None, None)]
    cache = spark.createDataFrame(rows, "date STRING, input_tokens BIGINT, output_tokens BIGINT, latency DOUBLE, error STRING, model STRING")
    found = {r.model: tuple(r)[1:] for r in G.generation_telemetry(cache).collect()}
    assert found == {"m": ("2024-01-01", 2, 4, 6, 2.0, 3.0, 0.5), None: ("2024-01-01", 1, 3, 4, 5.0, 5.0, 0.0)}


def test_sketches_of_commits_merge(spark):
    """20,000 calls in 40 commits: sums are exact, the quantile is within its bound; only sketches are read."""
    cache = spark.range(20_000).selectExpr("'m' as model", "'2024-01-01 10:00' as date", "id as input_tokens", "1L as output_tokens", "cast(pmod(hash(id), 100000) as double) as latency", "cast(null as string) as error", "id % 40 as k")
    path = scratch_path(spark, "telemetry")
    for k in range(40):
        sinks.append_results(G.telemetry_sketches(cache.filter(f"k = {k}")), path)
    sketches = spark.read.parquet(path)
    assert sketches.count() == 40
    found = G.merged_telemetry(sketches).first()
    assert (found.calls, found.input_tokens) == (20_000, sum(range(20_000)))
    assert abs(cache.filter(F.col("latency") <= found.p95_latency).count() / 20_000 - 0.95) < 0.01


def test_stub_is_deterministic():
    client = X.echo_client_factory()
    assert client("x about\nhello\nEND $1 \\") == client("x about\nhello\nEND $1 \\")


def test_new_passages_need_no_state():
    """Only failures reach the state: the first attempt is not in it, and a repeated report changes nothing."""
    import json

    import pandas as pd

    from passagemill.streaming.ingest import _decisions

    class State:
        exists, hasTimedOut, get = False, False, None

        def update(self, value):
            self.exists, self.get = True, value

    state, decide = State(), _decisions(3)
    report = lambda n: pd.DataFrame({"row": ["p"], "attempt": [n], "due": [0.0]})
    ask = lambda n: [tuple(x) for f in decide(("k",), [report(n)], state) for x in f.to_numpy()]
    assert ask(1) == [("p", 2)] and ask(1) == [] and ask(2) == [("p", 3)] and ask(3) == []
    assert json.loads(state.get[0]) == {"asked": {"p": 3}, "waiting": []}
