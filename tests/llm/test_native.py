"""Licence scan, external shuffle, host rules and source mixing: edge cases, brute force, SQL."""

import re
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from tidewatch.llm import host_rules, license_rules, licenses, mixing, sharding, sql
from tidewatch.llm.common import text_of

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def rows(df):
    return [r.asDict(recursive=True) for r in df.collect()]


# --- licences -------------------------------------------------------------------------------------------------------

def scanned(text, table=None):
    """The scan of one text by loops over matches."""
    words = WORD.findall(lower(text))
    line = " " + " ".join(words) + " "
    at = lambda pos: line[:pos].count(" ") - 1
    base = [(at(m.start()), label) for phrase, label in licenses.BASE for m in re.finditer(f"(?<= ){phrase}(?= )", line)]
    found = []
    for rank, rule in enumerate(table or license_rules.rules()):
        if f" {rule.keyword}" in line:
            for m in re.finditer(f"(?<= )(?:{rule.pattern})(?= )", line):
                found.append((at(m.start()), at(m.end()) + 1, rule.priority, rank, rule.label))
    kept = [d for d in found if not any(
        e is not d and e[0] <= d[0] and e[1] >= d[1] and e[2] <= d[2] and ((e[0], e[1]) != (d[0], d[1]) or (e[2], e[3]) < (d[2], d[3])) for e in found)]
    return len(words), sorted(p for p, _ in base), sorted({label for _, label in base}), sorted({d[4] for d in kept} | {label for _, label in base}), sorted((d[0], d[1], d[4]) for d in kept)


TEXTS = [
    "Licensed under the Apache License, Version 2.0 (the License)", "CC-BY-NC 4.0 and cc by nc sa", "SPDX-License-Identifier: GPL-3.0-or-later",
    "GNU Lesser General Public License version 2.1", "under the terms of the GNU General Public License, version 3", "All rights reserved. All Rights Reserved",
    "mit", "the MIT license, the BSD 3-Clause license", "under the mit license under the mit license", "Under the\x00MIT license", "KK under the mit licenſe",
    "", None, "Creative Commons Attribution-NonCommercial 4.0 International", "accept ccc by nc", "apache license version 20",
]


def test_scan_equals_loops(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    for r in rows(licenses.scan(df)):
        n, base, base_labels, labels, kept = scanned(r["text"])
        assert (r["n_words"], r["n_base"]) == (n, len(base)), r
        assert (r["first_word"], r["last_word"]) == ((base[0], base[-1]) if base else (None, None)), r
        assert (r["base_labels"], r["labels"]) == (",".join(base_labels), ",".join(labels)), r
        assert sorted((d["start"], d["stop"], d["label"]) for d in r["detections"]) == kept, r
        assert 0 <= r["score"] <= 1 and (r["score"] > 0) == bool(labels)


NOTICES = {
    "under the GNU GPL v3": "gpl-3", "under the GPL version 3": "gpl-3", "licensed under GPL version 2": "gpl-2", "under the GPL v1": "gpl-1", "General Public License version 1": "gpl-1",
    "written for the gnu gpl 2": "gpl-2", "X11 license": "mit", "under the Expat licence": "mit", "SPDX-License-Identifier: 0BSD": "0bsd", "the WTFPL": "wtfpl",
    "do what the fuck you want to public licence": "wtfpl",
}


def ways(parsed):
    """Texts a pattern matches: every branch, what is optional both with and without, other repeats at their least."""
    texts = [""]
    for kind, value in parsed:
        match str(kind):
            case "LITERAL":
                more = [chr(value)]
            case "IN":
                more = [chr(v) if str(k) == "LITERAL" else chr(v[0]) if str(k) == "RANGE" else "w" for k, v in value]
            case "BRANCH":
                more = [t for branch in value[1] for t in ways(branch)]
            case "SUBPATTERN":
                more = ways(value[3])
            case "MAX_REPEAT":
                low, high, inner = value
                more = [t * n for t in ways(inner) for n in ({0, 1} if (low, high) == (0, 1) else {low})]
        texts = [a + b for a in texts for b in dict.fromkeys(more)]
    return texts


def test_the_prefilter_loses_nothing(spark):
    table = license_rules.rules()
    for rule in table:
        for text in ways(re._parser.parse(rule.pattern)):
            assert re.fullmatch(rule.pattern, text) and f" {rule.keyword}" in f" {text}", (rule.id, text)
    ungated = [rule._replace(keyword="") for rule in table]
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*NOTICES, *TEXTS])], "doc_id long, text string")
    for r in rows(licenses.scan(df)):
        _, _, _, labels, kept = scanned(r["text"], ungated)
        assert r["labels"] == ",".join(labels) and sorted((d["start"], d["stop"], d["label"]) for d in r["detections"]) == kept, r
        assert r["labels"] == NOTICES.get(r["text"], r["labels"]), r


def test_rules_are_many_and_distinct():
    table = license_rules.rules()
    assert len(table) > 300 and len({r.id for r in table}) == len(table)
    assert [r.priority for r in table] == sorted(r.priority for r in table)


def test_a_tag_outranks_what_it_contains(spark):
    df = spark.createDataFrame([(1, "SPDX-License-Identifier: MIT")], "doc_id long, text string")
    assert [(d["label"], d["priority"]) for d in rows(licenses.scan(df))[0]["detections"]] == [("mit", 1)]


def test_scan_of_edge_rows(edge, nothing):
    got = rows(licenses.scan(edge))
    assert len(got) == edge.count()
    for r in got:
        assert (r["n_words"], r["n_base"]) == (scanned(r["text"])[0], len(scanned(r["text"])[1]))
    assert licenses.scan(nothing).count() == 0


# --- shards ---------------------------------------------------------------------------------------------------------

def test_shards_hold_every_row_once(edge):
    dealt = sharding.shards(edge, count=4, bucket_bytes=1 << 16)
    got = rows(dealt.select("doc_id", "text", "size", "shard", "slot"))
    key = lambda r: (r["doc_id"] or -1, r["text"] or "")
    assert sorted(map(key, got)) == sorted(map(key, rows(edge.select("doc_id", "text"))))
    by_shard = {}
    for r in got:
        assert r["size"] == len((r["text"] or "").encode()) + 16
        by_shard.setdefault(r["shard"], []).append(r["slot"])
    assert set(by_shard) <= set(range(4)) and all(sorted(v) == list(range(len(v))) for v in by_shard.values())
    assert max(map(len, by_shard.values())) - min(map(len, by_shard.values())) <= 1


def test_shards_of_a_table(spark, tiny):
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    one, two, other = (rows(sharding.shards(docs, seed=s, bucket_bytes=1 << 16).select("doc_id", "shard", "slot")) for s in (1, 1, 2))
    place = lambda x: {r["doc_id"]: (r["shard"], r["slot"]) for r in x}
    assert place(one) == place(two) != place(other)
    assert sorted(place(one).values()) == [(s, k) for s in range(40) for k in range(5)]


def test_no_rows_no_shards(nothing):
    assert sharding.shards(nothing).count() == 0


def test_a_row_repeated_often_spreads(spark):
    same = spark.range(4000).select(F.lit(1).alias("doc_id"), F.lit("x" * 50).alias("text"))
    table, total, buckets = sharding.shuffled_buckets(same, bucket_bytes=1 << 15)
    sizes = [r["count"] for r in table.groupBy("__bucket").count().collect()]
    assert sum(sizes) == total == 4000 and len(sizes) == buckets > 5 and max(sizes) < 2 * 4000 / buckets


def test_written_shards_keep_their_order(spark, tiny, tmp_path):
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    sharding.write_shards(sharding.shards(docs, count=3), str(tmp_path / "out"))
    read = spark.read.parquet(str(tmp_path / "out")).where("shard = 1").select("slot").collect()
    assert [r.slot for r in read] == list(range(len(read))) and len(read) in (66, 67)


# --- host rules -----------------------------------------------------------------------------------------------------

def counted(text):
    text = text or ""
    w = SPACE.findall(text)
    windows = {}
    for i in range(len(w) - 2):
        windows.setdefault(tuple(w[i : i + 3]), []).append(i)
    covered = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(3)}
    lines = [x for x in text.split("\n") if SPACE.search(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def test_counts_equal_loops(edge):
    for r in rows(host_rules.document_counts(edge)):
        assert tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == counted(r["text"]), r["doc_id"]


def test_verdicts(spark, nothing):
    good, bad = PROSE_TEXT, "x"
    data = [(i, good, "good") for i in range(40)] + [(100 + i, good if i == 0 else bad, "bad") for i in range(40)]
    data += [(200, bad, "small"), (201, good, "small"), (300, good, None), (301, bad, None)]
    got = {r["doc_id"]: r for r in rows(host_rules.apply_rules(spark.createDataFrame(data, "doc_id long, text string, source string")))}
    assert all(got[i]["kept"] for i in range(40))
    assert got[100]["host_rejected"] and not got[100]["base_failed"] and not got[100]["kept"]
    assert not got[201]["host_rejected"] and got[201]["kept"] and not got[200]["kept"]
    assert got[300]["kept"] and not got[301]["kept"]
    assert host_rules.apply_rules(nothing).count() == 0


PROSE_TEXT = " ".join(f"word{i}" for i in range(80))


def test_host_rules_equal_sql(spark, edge):
    compare(spark, edge, lambda d: host_rules.apply_rules(d), sql.host_rules("docs"), ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "host_rejected", "kept"])


# --- mixing ---------------------------------------------------------------------------------------------------------

def compare(spark, docs, run, text, columns):
    con = duckdb.connect()
    con.register("docs", docs.select("doc_id", "text", "source").toArrow())
    key = lambda x: sorted(x, key=repr)
    want = [tuple(r) for r in con.execute(f"SELECT {', '.join(columns)} FROM ({text})").fetchall()]
    assert key([tuple(r) for r in run(docs).select(*columns).collect()]) == key(want)


def test_mix_equals_sql(spark, edge, tiny):
    columns = ["doc_id", "size", "source_size", "target", "copies", "taken"]
    for docs in (edge, spark.read.parquet(f"{tiny}/documents.parquet")):
        compare(spark, docs, lambda d: mixing.mix(mixing.with_sizes(d), slice_rows=7), sql.mix("docs"), columns)


def test_mix_meets_its_targets(spark):
    data = [(i, f"s{i % 5}", (i * 7919) % 100) for i in range(4000)]
    docs = spark.createDataFrame(data, "doc_id long, source string, size long")
    got = rows(mixing.mix(docs, slice_rows=300).groupBy("source").agg(F.sum("taken").alias("t"), F.first("target").alias("g"), F.max("copies").alias("c"), F.first("source_size").alias("s")))
    for r in got:
        assert r["c"] <= 2 and abs(r["t"] - r["g"]) <= 200 and r["g"] <= 2 * r["s"]
    assert sum(r["g"] for r in got) == pytest.approx(1.5 * sum(r["s"] for r in got))


def test_emitted_copies(spark, edge, nothing):
    mixed = mixing.mix(mixing.with_sizes(edge))
    assert mixing.emit(mixed).count() == mixed.agg(F.sum("copies")).first()[0]
    assert mixing.mix(mixing.with_sizes(nothing)).count() == 0


def test_crc_of_a_null_text(edge):
    assert edge.where("text IS NULL").select(F.crc32(text_of(edge))).first()[0] == zlib.crc32(b"")
