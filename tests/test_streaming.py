"""Token streams: order, repeats, errors, restarts, and streaming = batch."""

import hashlib
import json
import random

import pytest
from pyspark.sql import functions as F

from lantern.plans import streams
from lantern.streaming import tokens


def event(request, seq, kind="token", content=None, message=None, at=0):
    return {
        "request_id": request, "seq": seq, "type": kind, "content": content, "message": message,
        "ts": f"2024-01-01T00:{at // 60:02d}:{at % 60:02d}",
    }


def write_lines(folder, name, events):
    (folder / f"{name}.txt").write_text("".join(f"data: {json.dumps(e)}\n\n" for e in events))


def run(spark, folder, out, checkpoint, files=None):
    events = tokens.parse_lines(tokens.read_lines(spark, str(folder), files)).where("corrupt is null")
    tokens.run_available(tokens.reassemble(events), str(out), str(checkpoint))
    rows = spark.read.schema(tokens.FINISHED).parquet(str(out)).collect()
    assert len({r.request_id for r in rows}) == len(rows)
    return {r.request_id: (r.status, r.predicted_answer, r.message, r.n_tokens) for r in rows}


@pytest.fixture
def folders(tmp_path):
    (tmp_path / "in").mkdir()
    return tmp_path / "in", tmp_path / "out", tmp_path / "checkpoint"


def test_ends_and_errors(spark, folders):
    write_lines(
        folders[0],
        "a",
        [
            event("one", 0, content="B"), event("one", 1, content="!"), event("one", 2, "done"),
            event("open", 0, content="x"),
            event("bad", 0, content="x"), event("bad", 1, "error", message="out of memory"),
            event("empty", 0, "done"),
            event("late", 2, "done"), event("late", 1, content="b"),
        ],
    )
    assert run(spark, *folders) == {
        "one": ("done", "B!", None, 2),
        "bad": ("error", None, "out of memory", 1),
        "empty": ("done", "", None, 0),
    }


def test_any_order_over_many_files_and_a_restart(spark, folders):
    rng = random.Random(3)
    texts = {f"r{i}": ["tok%d " % k for k in range(rng.randint(1, 30))] for i in range(12)}
    events = [event(r, k, content=t, at=k) for r, ts in texts.items() for k, t in enumerate(ts)]
    events += [event(r, len(ts), "done", at=len(ts)) for r, ts in texts.items()]
    events += rng.sample(events, 20)  # repeats
    rng.shuffle(events)
    third = len(events) // 3
    for n in range(2):
        write_lines(folders[0], f"f{n}", events[n * third : (n + 1) * third])
    before = run(spark, *folders, files=1)
    write_lines(folders[0], "f2", events[2 * third :])
    after = run(spark, *folders, files=1)
    assert before.items() <= after.items()
    assert after == {r: ("done", "".join(ts), None, len(ts)) for r, ts in texts.items()}


def test_requests_that_never_close_are_forgotten(spark, folders):
    write_lines(folders[0], "f0", [event("old", 0, content="x"), event("new", 0, content="y", at=3)])
    assert run(spark, *folders, files=1) == {}
    # three hours on: both are past, and what comes now for one of them begins anew
    later = {**event("other", 0, "done"), "ts": "2024-01-01T03:00:00"}
    write_lines(folders[0], "f1", [later])
    run(spark, *folders, files=1)
    end = {**event("new", 1, "done"), "ts": "2024-01-01T03:00:01"}
    write_lines(folders[0], "f2", [end])
    got = run(spark, *folders, files=1)
    assert got.keys() == {"other", "old", "new"} and "expired" in got["old"] and "expired" in got["new"]


def test_a_long_request_beside_many(spark, folders):
    """A third of all tokens belong to one request."""
    sizes = {"hot": 3000, **{f"r{i}": 20 for i in range(300)}}
    events = [event(r, k, content=f"{k},") for r, n in sizes.items() for k in range(n)]
    events += [event(r, n, "done") for r, n in sizes.items()]
    random.Random(1).shuffle(events)
    write_lines(folders[0], "a", events)
    got = run(spark, *folders)
    assert got == {r: ("done", "".join(f"{k}," for k in range(n)), None, n) for r, n in sizes.items()}


def test_frames(spark, folders):
    (folders[0] / "a.txt").write_text(
        'data: {"request_id": "a", "seq": 0, "type": "token", "content": "x\\ny"}\n\n'
        ": comment\nevent: token\ndata:{}\n"
        "data: {broken\n"
        'data: {"type": "done"}'
    )
    stream = tokens.parse_lines(tokens.read_lines(spark, str(folders[0])))
    tokens.run_available(stream, str(folders[1]), str(folders[2]))
    rows = spark.read.schema(f"{tokens.EVENT}, corrupt string").parquet(str(folders[1])).collect()
    assert sorted((r.type or "", r.content, r.corrupt) for r in rows) == [
        ("", None, "{broken"), ("done", None, None), ("token", "x\ny", None),
    ]


def test_scores_of_a_stream_are_those_of_the_batch(spark, folders):
    rows = [("a", "mmlu", "Answer: B", "b"), ("b", "gsm8k", "it is 99", "100"), ("c", "foo", " X", "x"), ("d", "foo", "y", "x")]
    schema = "request_id string, dataset string, predicted_answer string, gold_answer string"
    df = spark.createDataFrame(rows, schema)
    df.write.mode("append").parquet(str(folders[0]))
    stream = tokens.score_stream(spark.readStream.schema(schema).parquet(str(folders[0])))
    wanted = tokens.score_stream(df).select("request_id", "score", "metric").collect()
    tokens.run_available(stream.select("request_id", "score", "metric"), str(folders[1]), str(folders[2]))
    got = spark.read.schema("request_id string, score double, metric string").parquet(str(folders[1])).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, wanted))
    assert [r.score for r in sorted(got)] == [1.0, 1.0, 1.0, 0.0]


def test_tokens_give_the_text_back(spark):
    texts = ["a b  c\n\nd ", "  lead", "", "one", "é\tü\n"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(F.array_join(tokens.text_tokens("t"), "")).collect()] == texts


def test_wire_line(spark):
    df = spark.createDataFrame([("x\n\"y\"",)], "t string")
    line = df.select(tokens.wire_line(type=F.lit("token"), content=F.col("t"))).first()[0]
    assert line.startswith("data: ") and "\n" not in line
    assert json.loads(line[6:]) == {"type": "token", "content": 'x\n"y"'}


def test_dead_letters_after_a_failure_between_the_writes(spark, folders, monkeypatch):
    """Two tables, whole and without repeats, though the run breaks off after the first write of a batch."""
    for i in range(6):
        lines = [f"data: {json.dumps(event(f'r{i}', k, content=str(k)))}" for k in range(20)]
        lines += [f'data: {{"request_id": "broken{i}-{k}"' for k in range(3)] + [": a comment", ""]
        (folders[0] / f"{i}.txt").write_text("\n".join(lines))
    out, letters, checkpoint = (str(folders[1].parent / n) for n in ("events", "letters", "routed"))
    plain, calls = tokens.write_batch, []

    def failing(part, path, batch):
        calls.append(path)
        if len(calls) == 4:
            raise RuntimeError("lost in the middle")
        plain(part, path, batch)

    def routed():
        events = tokens.parse_lines(tokens.read_lines(spark, str(folders[0]), files_per_trigger=2))
        tokens.run_routed(events, out, letters, checkpoint)

    monkeypatch.setattr(tokens, "write_batch", failing)
    with pytest.raises(Exception, match="lost in the middle"):
        routed()
    monkeypatch.setattr(tokens, "write_batch", plain)
    routed()
    routed()
    read = spark.read.parquet(out).collect()
    assert sorted((r.request_id, r.seq) for r in read) == sorted((f"r{i}", k) for i in range(6) for k in range(20))
    dead = spark.read.parquet(letters)
    assert dead.columns == ["corrupt", "batch"]
    assert sorted(r.corrupt for r in dead.collect()) == sorted(f'{{"request_id": "broken{i}-{k}"' for i in range(6) for k in range(3))


@pytest.mark.parametrize("files", [1, 5])
def test_a_table_of_several_files_as_a_stream(spark, tmp_path, files):
    """A table may be one file or a folder of them; either way all its requests come."""
    rows = [(i, 1, "assistant", f"answer {i} ") for i in range(40)]
    talks = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    talks.repartition(files).write.parquet(str(tmp_path / "out"))
    if files == 1:
        (only,) = (tmp_path / "out").glob("*.parquet")
        (tmp_path / "conversations.parquet").write_bytes(only.read_bytes())
    else:
        talks.repartition(files).write.parquet(str(tmp_path / "conversations.parquet"))
    got = streams.stream_reassemble(spark, str(tmp_path)).where("status = 'done'").collect()
    hung = [i for i in range(40) if hashlib.md5(f"{i}-1".encode()).hexdigest()[0] in (streams.FAILS, streams.HANGS)]
    assert {r.request_id: r.predicted_answer for r in got} == {f"{i}-1": f"answer {i} " for i in range(40) if i not in hung}
