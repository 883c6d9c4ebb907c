"""Streaming: the stateless parse applies to files arriving in a folder."""

import os

from keyline.streaming import split_stream, stream_records


def test_stream_parse_and_quarantine(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    os.makedirs(src)
    with open(os.path.join(src, "a.txt"), "w") as f:
        f.write("2. b\nbad\n+01. a \n")
    good, bad = split_stream(stream_records(spark, src))
    qg = good.writeStream.format("memory").queryName("kl_good").outputMode("append").start()
    qb = bad.writeStream.format("memory").queryName("kl_bad").outputMode("append").start()
    try:
        qg.processAllAvailable()
        qb.processAllAvailable()
        with open(os.path.join(src, "b.txt"), "w") as f:
            f.write("3. c\n")
        qg.processAllAvailable()
        qb.processAllAvailable()
    finally:
        qg.stop()
        qb.stop()
    rows = sorted((r.number, r.text) for r in spark.sql("SELECT * FROM kl_good").collect())
    assert rows == [(1, "a"), (2, "b"), (3, "c")]
    rejects = spark.sql("SELECT * FROM kl_bad").collect()
    assert [(r.value, r.parse_error) for r in rejects] == [
        ("bad", "Malformed line: no dot or no text after dot. Value: bad")
    ]


def test_stream_file_sink_resumes(spark, tmp_dir):
    from keyline.sources.lines import read_lines
    from keyline.streaming import write_line_stream

    src = os.path.join(tmp_dir, "in2")
    out = os.path.join(tmp_dir, "out2")
    ck = os.path.join(tmp_dir, "ck2")
    os.makedirs(src)
    with open(os.path.join(src, "a.txt"), "w") as f:
        f.write("2. b\nbad\n+01. a \n")
    records = stream_records(spark, src)
    good = records.where("parse_error is null")
    write_line_stream(good, out, ck, trigger_once=True).awaitTermination(120)
    with open(os.path.join(src, "b.txt"), "w") as f:
        f.write("3. c\n")
    # A new query on the same checkpoint reads only the file it has not seen.
    write_line_stream(stream_records(spark, src).where("parse_error is null"), out, ck, trigger_once=True).awaitTermination(120)
    got = sorted(r.value for r in read_lines(spark, out).collect())
    assert got == ["1. a", "2. b", "3. c"]


def test_stream_restart_with_the_default_location(spark, tmp_dir):
    from keyline.sources.lines import read_lines
    from keyline.streaming import write_line_stream

    src, out = os.path.join(tmp_dir, "in3"), os.path.join(tmp_dir, "out3")
    os.makedirs(src)
    for name, lines in (("a", "1. a\n2. b\n"), ("b", "3. c\n4. d\n")):
        with open(os.path.join(src, f"{name}.txt"), "w") as f:
            f.write(lines)
        good = stream_records(spark, src).where("parse_error is null")
        write_line_stream(good, out, trigger_once=True).awaitTermination(120)
    assert sorted(r.value for r in read_lines(spark, out).collect()) == ["1. a", "2. b", "3. c", "4. d"]
