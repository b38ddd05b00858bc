from __future__ import annotations

import random
from collections import Counter

import pytest

from ledgerstrata.llm import lines
from ledgerstrata.llm.lines import MIN_CHARS, Keys, lines_of, within

from . import edge


def distance(a, b, most=8):
    """Edits between a and b, cell by cell within a band; over `most` if they are more."""
    row = {j: j for j in range(min(len(b), most) + 1)}
    for i, x in enumerate(a, 1):
        new = {}
        for j in range(max(0, i - most), min(len(b), i + most) + 1):
            step = row[j - 1] + (x != b[j - 1]) if j and j - 1 in row else most + 1
            new[j] = min(step, row.get(j, most) + 1, new.get(j - 1, most) + 1)
        row = new
    return row.get(len(b), most + 1)


def changed(rng, line, edits):
    for _ in range(edits):
        at, new = rng.randrange(len(line) + 1), rng.choice(["", "x", "é", "zq"])
        line = line[:at] + new[:1] + line[at + (rng.random() < 0.5 or not new) :]
    return line


def brute(given, edits):
    first = {}
    key = lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["text"] or "")
    unique = {(r["doc_id"], r["text"]): r for r in given}
    for r in sorted(unique.values(), key=key):
        for at, line in lines_of(r["text"] or ""):
            first.setdefault(line, (*key(r), at))
    long = [x for x in first if len(x) >= MIN_CHARS]
    pairs = [(a, b) for i, a in enumerate(long) for b in long[:i] if abs(len(a) - len(b)) <= edits and distance(a, b) <= edits]
    near = {max(p, key=first.get) for p in pairs}
    count = Counter(x for p in pairs for x in p)
    out = Counter()
    for r in given:
        found = lines_of(r["text"] or "")
        copy = {at for at, line in found if first[line] != (*key(r), at)}
        gone = copy | {at for at, line in found if line in near}
        text = None if r["text"] is None else "\n".join(x for i, x in enumerate(r["text"].split("\n")) if i not in gone)
        out[(r["doc_id"], text, len(found), len(copy), len(gone - copy), sum(count[line] for _, line in found))] += 1
    return out, pairs


def documents(spark):
    rng = random.Random(4)
    made = [edge.words(rng, rng.randrange(4, 12)) for _ in range(25)]
    made += [changed(rng, rng.choice(made), rng.randrange(4)) for _ in range(60)]
    made += ["all of these lines share their first and second part " + str(i) for i in range(20)]
    rows = [(100 + i, "\n".join(rng.choices(made, k=rng.randrange(1, 7))), "en", "s", 0) for i in range(60)]
    # The two rows without id have texts whose order is not that of their hashes; one of them is enough.
    docs = edge.docs(spark).where("doc_id is not null or text is not null")
    more = spark.createDataFrame(rows, edge.SCHEMA)
    for name in edge.CLASHING:
        more = more.selectExpr("*", f"'x' as `{name}`")
    return docs.union(more)


@pytest.mark.parametrize(("hot", "broadcast"), [(2000, 1_000_000), (3, 0)])
def test_equals_brute_force(spark, monkeypatch, hot, broadcast):
    """Also with hot keys refined over several rounds and without a broadcast."""
    monkeypatch.setattr(lines, "HOT", hot)
    monkeypatch.setattr(lines, "BROADCAST_LINES", broadcast)
    docs = documents(spark)
    expected, pairs = brute(edge.rows(docs), 2)
    assert len(pairs) > 50
    found = lines.thin(docs)
    assert found.columns == [*docs.columns, *lines.ADDED]
    assert Counter((r["doc_id"], r["text"], *(r[c] for c in lines.ADDED)) for r in edge.rows(found)) == expected


def test_band():
    rng = random.Random(1)
    for edits in (1, 2, 4):
        pairs = []
        for _ in range(400):
            a = edge.words(rng, rng.randrange(0, 12))
            pairs.append((a, changed(rng, a, rng.randrange(edits + 3))))
        pairs += [("", ""), ("", "ab"), ("a" * 3000, "a" * 2999 + "b"), ("x" * 40, "y" * 40)]
        assert within(pairs, edits).tolist() == [distance(a, b) <= edits for a, b in pairs]


def test_keys_meet():
    rng = random.Random(2)
    for edits in (1, 2, 3):
        for _ in range(300):
            a = edge.words(rng, 8)
            b = changed(rng, a, edits)
            if min(len(a), len(b)) < MIN_CHARS or distance(a, b) > edits:
                continue
            level = [Keys(edits)]
            for _ in range(3):
                ka, kb = level[-1].of(a), level[-1].of(b)
                assert any(k in kb and (ka[k] or kb[k]) for k in ka)
                level.append(Keys(edits, level[-1].hot | frozenset(ka) | frozenset(kb)))


def test_documents_and_empty(spark):
    docs = edge.docs(spark)
    out = lines.documents(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    assert all(r["n_chars"] == (None if r["text"] is None else len(r["text"])) for r in edge.rows(out))
    assert lines.thin(edge.empty(spark)).collect() == []


def test_a_line_is_once_in_a_key(spark, monkeypatch):
    """Keys that an earlier round has settled do not come out again when a third round refines others."""
    monkeypatch.setattr(lines, "HOT", 3)
    docs = documents(spark).selectExpr("xxhash64(doc_id, text) as k", "text", "doc_id")
    members = lines.candidates(docs)
    assert members.groupBy("key", "h", "i", "j").count().where("count > 1").collect() == []


def test_hot_keys_too_short_to_refine(spark, monkeypatch):
    monkeypatch.setattr(lines, "HOT", 3)
    rows = [(i, f"abcdefghijklmnopqrstuv{i:02d}", "en", "s", 0) for i in range(40)]
    docs = spark.createDataFrame(rows, edge.SCHEMA)
    expected, _ = brute(edge.rows(docs), 2)
    found = lines.thin(docs)
    assert Counter((r["doc_id"], r["text"], *(r[c] for c in lines.ADDED)) for r in edge.rows(found)) == expected


def test_no_group_grows_with_its_key(spark, monkeypatch):
    """Lines that no refining can part are dealt in pairs of blocks."""
    monkeypatch.setattr(lines, "HOT", 20)
    rows = [(i, f"abcdefghijklmnopqrstuv{chr(200 + i)}", "en", "s", 0) for i in range(300)]
    rows += [(500 + i, f"abcdefghijklmnopqrstuv{chr(200 + i)}{chr(300 + i)}", "en", "s", 0) for i in range(300)]
    docs = spark.createDataFrame(rows, edge.SCHEMA)
    members = lines.candidates(docs)
    assert members.groupBy("key", "i", "j").count().selectExpr("max(count)").first()[0] < 4 * 20
    expected, _ = brute(edge.rows(docs), 2)
    found = lines.thin(docs)
    assert Counter((r["doc_id"], r["text"], *(r[c] for c in lines.ADDED)) for r in edge.rows(found)) == expected


def test_a_repeated_row_has_each_mark_once(spark):
    """The marks of a document are as many as its lines, not times its rows."""
    marked = spark.range(120).selectExpr("7L as k", "8L as l", "cast(id % 3 as int) as pos", "true as copy", "false as near", "0L as links")
    assert [len(r["_llm_marks"]) for r in lines.listed(marked).collect()] == [3]
    rows = [(1, "one\ntwo\nthree", "en", "s", 0)] * 40 + [(0, "two", "en", "s", 0)]
    docs = spark.createDataFrame(rows, edge.SCHEMA).repartition(4)
    expected, _ = brute(edge.rows(docs), 2)
    found = lines.thin(docs)
    assert Counter((r["doc_id"], r["text"], *(r[c] for c in lines.ADDED)) for r in edge.rows(found)) == expected


def test_first_keys_are_those_of_the_line():
    """`first` reads its places from a table by length; nothing hot, it has the keys of `of`, whatever the length."""
    rng, maker = random.Random(7), lines.Keys(lines.EDITS)
    for n in [*range(lines.MIN_CHARS - 1, 90), 400]:
        for letters in ("ab", "abcdefghijklmnopqrstuvwxyz é中😀", "a"):
            line = "".join(rng.choice(letters) for _ in range(n))
            found = maker.first(line)
            assert {lines._signed(k): own for k, own in found.items()} == lines.Keys(lines.EDITS).of(line)
