"""Log lines, stacks, marks and polls, against a plain line-by-line model."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from ticketlake.operators import logs
from ticketlake.operators.audit import log_alert
from ticketlake.operators.lookup import number_rows
from ticketlake.plans.log_poll import poll_logs, read_events
from ticketlake.sources.loglines import read_log_lines, tail_lines
from ticketlake.streaming.growing_logs import stream_growing_logs
from ticketlake.streaming.logs import stream_logs

HEAD = "2026-05-04 12:01:{:02d},116 {} mod.a :: {}"


def expected_events(lines):
    """Messages by walking the lines of one file."""
    import re

    head = re.compile(logs.HEADER.replace("(?s:(.+))", "(.+)"), re.DOTALL)
    found = []
    for i, line in enumerate(lines):
        match = head.match(line)
        if not match:
            continue
        if match[2] == "WARN" and not re.search(logs.RELEVANT, match[4]):
            continue
        text = [match[4]]
        for follow in lines[i + 1 : i + 6]:
            if not re.match(logs.STACK, follow):
                break
            text.append(follow.strip())
        found.append((i + 1, match[2], "\n".join(text)[:4000]))
    return found


def frame(spark, lines, name="f"):
    return spark.createDataFrame(
        [(name, i + 1, line) for i, line in enumerate(lines)], "log_file string, line_no long, line string"
    )


def random_lines(seed, size=400):
    rng = random.Random(seed)
    kinds = [
        lambda: HEAD.format(rng.randrange(60), "ERROR", "boom"),
        lambda: HEAD.format(rng.randrange(60), "WARN", rng.choice(["SQL slow", "cache"])),
        lambda: HEAD.format(rng.randrange(60), "INFO", "sql"),
        lambda: "\tat x.y.Z " + str(rng.random()),
        lambda: "Caused by: q",
        lambda: "com.microsoft.z",
        lambda: "plain",
        lambda: "",
    ]
    weights = [2, 2, 1, 8, 3, 2, 1, 1]
    return [rng.choices(kinds, weights)[0]() for _ in range(size)]


@pytest.mark.parametrize("chunk", [3, 7, 50_000])
def test_events_match_model(spark, chunk):
    lines = random_lines(chunk)
    got = logs.parse_events(frame(spark, lines), chunk=chunk).orderBy("line_no").collect()
    assert [(r.line_no, r.nivel, r.mensagem) for r in got] == expected_events(lines)


def test_stack_is_cut_after_five_lines_and_at_the_limit(spark):
    lines = [HEAD.format(1, "ERROR", "x" * 3990)] + [f"  at line {i}" for i in range(7)]
    row = logs.parse_events(frame(spark, lines)).first()
    assert len(row.mensagem) == 4000
    short = logs.parse_events(frame(spark, [HEAD.format(1, "ERROR", "m"), *lines[1:]])).first()
    assert short.mensagem == "m\nat line 0\nat line 1\nat line 2\nat line 3\nat line 4"


def test_mark_and_impossible_time(spark):
    lines = [
        HEAD.format(1, "ERROR", "old"),
        HEAD.format(2, "ERROR", "same second"),
        HEAD.format(3, "ERROR", "new"),
        "2026-02-30 00:00:00,1 ERROR m :: no such day",
    ]
    events = logs.extract_events(frame(spark, lines), dt.datetime(2026, 5, 4, 12, 1, 2))
    assert sorted(r.mensagem for r in events.collect()) == ["new", "no such day"]
    assert logs.extract_events(frame(spark, lines), None).count() == 4


def test_alert(spark):
    lines = [HEAD.format(9, "WARN", "sql"), HEAD.format(5, "ERROR", "a" * 900), HEAD.format(1, "ERROR", "b")]
    row = log_alert(logs.parse_events(frame(spark, lines))).first()
    assert row.qt_erros == 2 and row.ds_amostra == "a" * 400
    assert log_alert(logs.parse_events(frame(spark, lines[:1]))).count() == 0


def test_numbers_of_a_large_group(spark):
    data = [("a" if i % 10 else "b", i * 7919 % 1000, i) for i in range(1000)]
    df = spark.createDataFrame(data, "g string, o int, i int")
    block = F.floor(F.col("o") / 50)
    plain = number_rows(df, ["o", "i"], "n", ["g"])
    split = number_rows(df, ["o", "i"], "n", ["g"], block)
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, split.collect()))
    whole = number_rows(df.drop("g"), ["o", "i"], "n", block=block)
    assert [r.n for r in whole.orderBy("o", "i").collect()] == list(range(1, 1001))


def test_line_numbers_over_many_splits(spark, tmp_path):
    lines = [f"line {i} " + "x" * (i % 50) for i in range(5000)]
    (tmp_path / "a.log").write_bytes("\r\n".join(lines).encode())
    (tmp_path / "b.log").write_text("one\ntwo\x0cthree\n\nfive\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8000")
    try:
        got = read_log_lines(spark, str(tmp_path), None).collect()
        tail = read_log_lines(spark, str(tmp_path), 3).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    by_file = {}
    for row in got:
        by_file.setdefault(row.log_file[-5:], {})[row.line_no] = row.line
    assert [by_file["a.log"][i + 1] for i in range(5000)] == lines
    assert by_file["b.log"] == {1: "one", 2: "two", 3: "three", 4: "", 5: "five"}
    assert sorted((r.log_file[-5:], r.line) for r in tail) == sorted(
        [("a.log", x) for x in lines[-3:]] + [("b.log", x) for x in ("three", "", "five")]
    )


def test_tail_of_numbered_lines(spark):
    lines = frame(spark, [str(i) for i in range(10)]).unionByName(frame(spark, ["z"], "g"))
    assert sorted(r.line for r in tail_lines(lines, 2).collect()) == ["8", "9", "z"]


def test_polls_capture_each_event_once(spark, tmp_path):
    log, events = tmp_path / "server.log", str(tmp_path / "events")
    first = [HEAD.format(1, "ERROR", "one"), "  at a", HEAD.format(2, "WARN", "jdbc")]
    log.write_text("\n".join(first) + "\n")
    ts = dt.datetime(2026, 5, 4, 13)
    added, alert = poll_logs(spark, str(log), events, "1", ts)
    assert added.count() == 2 and alert.first().ds_amostra == "one\nat a"
    log.write_text("\n".join([*first, HEAD.format(3, "ERROR", "three")]) + "\n")
    added, _ = poll_logs(spark, str(log), events, "2", ts)
    assert [r.mensagem for r in added.collect()] == ["three"]
    poll_logs(spark, str(log), events, "2", ts)  # the same poll again replaces itself
    assert sorted(r.id_log for r in read_events(spark, events).collect()) == [1, 2, 3]


def test_stream_of_closed_files(spark, tmp_path):
    folder, events = tmp_path / "logs", str(tmp_path / "events")
    folder.mkdir()
    (folder / "1.log").write_text(HEAD.format(9, "ERROR", "late") + "\n")
    stream_logs(spark, str(folder), str(tmp_path / "cp"), events).awaitTermination()
    (folder / "2.log").write_text(HEAD.format(1, "ERROR", "early") + "\n")
    stream_logs(spark, str(folder), str(tmp_path / "cp"), events).awaitTermination()
    assert sorted(r.mensagem for r in read_events(spark, events).collect()) == ["early", "late"]


def growing(spark, tmp_path, **options):
    """One poll of the folder's growing files; rows that the source read."""
    query = stream_growing_logs(
        spark, str(tmp_path / "logs"), str(tmp_path / "cp"), str(tmp_path / "events"), **options
    )
    query.awaitTermination()
    return sum(p["numInputRows"] for p in query.recentProgress)


def captured(spark, tmp_path):
    rows = read_events(spark, str(tmp_path / "events")).collect()
    return sorted((r.nivel, r.mensagem) for r in rows)


@pytest.mark.parametrize("seed", [1, 2])
def test_polls_of_growing_files_equal_one_poll(spark, tmp_path, seed):
    """Files that grow by any number of bytes, in the middle of stacks and of lines."""
    rng = random.Random(seed)
    folder = tmp_path / "logs"
    folder.mkdir()
    texts = {f"{name}.log": random_lines(seed * 10 + i, 120) for i, name in enumerate("ab")}
    data = {name: ("\r\n" if name == "b.log" else "\n").join([*lines, "end", ""]).encode() for name, lines in texts.items()}
    cuts = {name: sorted(rng.sample(range(1, len(d)), 3)) + [len(d)] for name, d in data.items()}
    for poll in range(4):
        for name, d in data.items():
            (folder / name).write_bytes(d[: cuts[name][poll]])
        growing(spark, tmp_path, blockBytes=700)
    want = [(level, text) for lines in texts.values() for _, level, text in expected_events(lines)]
    assert captured(spark, tmp_path) == sorted(want)


def test_a_poll_reads_only_new_lines_and_old_events_go_out(spark, tmp_path):
    folder = tmp_path / "logs"
    folder.mkdir()
    log = folder / "a.log"
    log.write_text(HEAD.format(1, "ERROR", "one") + "\n  at a\n" + "plain\n" * 50 + HEAD.format(2, "ERROR", "two") + "\n")
    assert growing(spark, tmp_path, wait_seconds=0) > 0
    # The open event went out with the news of the same poll, as there is no wait.
    first = captured(spark, tmp_path)
    assert ("ERROR", "one\nat a") in first
    with log.open("a") as f:
        f.write("plain\nplain\n")
    assert growing(spark, tmp_path, wait_seconds=0) == 2
    assert captured(spark, tmp_path) == [("ERROR", "one\nat a"), ("ERROR", "two")]
    assert growing(spark, tmp_path) == 0
    # A file that starts anew is read from its start.
    log.write_text(HEAD.format(3, "ERROR", "three") + "\nplain\n")
    growing(spark, tmp_path)
    assert ("ERROR", "three") in captured(spark, tmp_path)
