"""Sharding, collocations and conversation repair against plain versions."""

import collections
import functools
import hashlib
import itertools
import random
import re
import zlib

import pytest

from riskframe.llm import collocations, conversations, sharding

DOCS = "doc_id long, text string, lang string, shard int, slot long, range int, key string, n long, at long, size string"
TALK = "conv_id long, turn long, role string, text string, code int, kind string, at long, digest string"


def docs_frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, 1, 1, 1, "x", 1, 1, "x") for i, t, lang in rows], DOCS)


def odd_docs():
    rng = random.Random(5)
    rows = [(1, None, None), (2, "", "en"), (3, " \n\t", "en"), (None, "one two", "und"), (None, "one two", None), (4, "x", "de")]
    rows += [(5, "one two", "en"), (5, "one two", "en"), (6, "é" * 5_000 + " the end. " * 40, "fr")]
    rows += [(10 + i, " ".join(rng.choice("the of a new york city in san new york".split()) for _ in range(rng.randrange(60))), "en") for i in range(150)]
    rows += [(300 + i, "New York! new\tyork;New york,\rof the\x01 the\x01 the\x0bof the", ("en", None, "a\tb\n")[i % 3]) for i in range(60)]
    rows += [(1_000 + i, "same words in all of these", "en") for i in range(200)]
    return rows


# sharding


def plain_shards(rows, shards=16, whole=0.01):
    def key(r):
        return [int(hashlib.md5(x.encode()).hexdigest()[:15], 16) for x in (r[1] or "", "" if r[0] is None else str(r[0]))]

    order = sorted(rows, key=key)
    sizes = [len((r[1] or "").encode()) + 1 for r in order]
    total, spans, at = sum(sizes), {}, 0
    before = [0, *itertools.accumulate(sizes)]
    for i, r in enumerate(order):
        first, _ = spans.get(r[1] or "", (before[i], 0))
        spans[r[1] or ""] = first, before[i + 1]
    cuts = []
    for c in (total * j // shards for j in range(1, shards)):
        for first, last in spans.values():
            if first < c < last and last - first <= whole * total / shards:
                c = first if 2 * c <= first + last else last
                break
        cuts.append(c)
    out, slots = [], collections.Counter()
    for i, r in enumerate(order):
        shard = sum(2 * c <= 2 * before[i] + sizes[i] for c in cuts)
        out.append((r[0], sizes[i], zlib.crc32((r[1] or "").encode()), "bytes", shard, slots[shard], None))
        slots[shard] += 1
    return out


@pytest.mark.parametrize("rows_per_range", [20, 1_000])
def test_shards_equal_plain_version(spark, rows_per_range):
    rows = odd_docs()
    got = [tuple(r) for r in sharding.assign_shards(docs_frame(spark, rows).repartition(7), rows_per_range=rows_per_range).collect()]
    assert sorted(got, key=str) == sorted(plain_shards(rows), key=str)


def test_shards_of_hot_groups_are_near_equal(spark):
    """A third of all rows are one short text, a third of all bytes another text: ranges are subdivided, groups divided."""
    rng = random.Random(6)
    rows = [(i, "tiny", "en") for i in range(1_000)] + [(5_000 + i, "b" * 900, "en") for i in range(200)]
    rows += [(9_000 + i, "".join(rng.choice("abcdef ") for _ in range(rng.randrange(5, 300))), "en") for i in range(2_000)]
    df = docs_frame(spark, rows).repartition(6)
    got = sharding.assign_shards(df, rows_per_range=50).collect()
    totals = collections.Counter()
    for r in got:
        totals[r["shard"]] += r["size"]
    assert set(totals) == set(range(16)) and max(totals.values()) - min(totals.values()) < 2_000
    for shard in totals:
        assert sorted(r["slot"] for r in got if r["shard"] == shard) == list(range(sum(r["shard"] == shard for r in got)))
    sized = sharding.sized_rows(df, "doc_id", "text")
    _, stats = sharding.ranged_rows(sized, len(rows), sum(totals.values()), 50)
    assert max(r["n"] for r in stats.collect()) <= 2 * sharding.OVERFULL * 50


def test_range_of_compares_whole_keys():
    import numpy as np

    rng = random.Random(7)
    keys = [tuple(rng.randrange(3) for _ in range(3)) for _ in range(200)]
    bounds = sorted(set(keys[:9]))
    got = sharding.range_of([np.array(c) for c in zip(*keys)], np.array(bounds, sharding.KEY_TYPE))
    assert list(got) == [sum(b <= k for b in bounds) for k in keys]


def test_written_shards(spark, tmp_path):
    rows = odd_docs()
    df = docs_frame(spark, rows).drop("shard").repartition(5)
    sharding.write_shards(df, str(tmp_path / "out"), rows_per_range=50)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(back.columns) == sorted([*df.columns, "shard"])
    want = collections.Counter((r[0], r[4]) for r in plain_shards(rows))
    assert collections.Counter((r["doc_id"], r["shard"]) for r in back.collect()) == want
    with pytest.raises(ValueError):
        sharding.write_shards(df.withColumnRenamed("slot", "shard"), str(tmp_path / "no"))


# collocations


def plain_collocations(rows, least=10, top=2_000):
    counts = collections.defaultdict(collections.Counter)
    for _, text, lang in rows:
        text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split("[.,;:!?\n-\r]", text):
            words = re.findall("[^ \t]+", piece)
            for k in (1, 2, 3):
                counts["und" if lang is None else lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        n = sum(v for g, v in f.items() if len(g) == 1)
        rows_of = []
        for g, a in f.items():
            if len(g) == 1 or a < least:
                continue
            cuts = [(10**6 * a * a // (f[g[:k]] * f[g[k:]]), k) for k in range(1, len(g))]
            score, k = min(cuts)
            around = [v for h, v in f.items() if len(h) > len(g) and v >= least and g in (h[:2], h[1:])]
            if 100 * max(around, default=0) < 50 * a:
                rows_of.append((-score, -a, " ".join(g).encode(), f[g[:k]], f[g[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rows_of)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return out


@pytest.mark.parametrize("bytes_per_range", [200, 1 << 23])
def test_collocations_equal_plain_version(spark, bytes_per_range):
    rows = odd_docs()
    df = docs_frame(spark, rows).repartition(5)
    got = [tuple(r) for r in collocations.collocations(df, bytes_per_range=bytes_per_range).collect()]
    assert sorted(got) == sorted(plain_collocations(rows)) and len(got) > 20
    few = collocations.collocations(df, bytes_per_range=bytes_per_range, top=2).collect()
    assert sorted(map(tuple, few)) == sorted(r for r in got if r[1] <= 2)


def test_run_keeps_context_over_long_pieces():
    words = [f"w{i % 7}".encode() for i in range(50)]
    whole, parts = collocations.Run(), collocations.Run()
    whole.add(words, 0, 50)
    for start in range(0, 50, 8):
        parts.add(words, start, min(start + 8, 50))
    for run in (whole, parts):
        keys, n = run.counted()
        assert dict(zip(keys.to_pylist(), n)) == collections.Counter(
            b"\t".join(reversed(([b"", b"", *words])[i : i + 3])) + b"\t" for i in range(50)
        )
        assert keys.to_pylist() == sorted(keys.to_pylist())


def test_least_cut_is_exact():
    a, left, right = 2**40 + 1, 2**41 + 7, 2**42 + 9
    assert collocations.least_cut(a, [left, left], [right, right]) == (left, right, 10**6 * a * a // (left * right))


# conversations


@functools.cache
def plain_repair(rows, state=""):
    """(cost, audit, roles) by trying every edit; rows are (initial, fault)."""
    legal = {"": "su", "s": "u", "u": "a", "a": "u"}[state]
    options = []
    turn = "a" if state == "u" else "u"
    if not rows:
        if state in ("", "a"):
            return 0, ""
        cost, audit = plain_repair(rows, turn)
        return cost + 2, "I" + audit
    (initial, fault), rest = rows[0], rows[1:]
    cost, audit = plain_repair(rest, state)
    options.append((cost + 3, "D" + audit))
    if fault not in (1, 2):
        cut_off = int(fault == 3)
        if initial in legal and initial:
            cost, audit = plain_repair(rest, initial)
            options.append((cost + cut_off, "K" + audit))
        cost, audit = plain_repair(rest, turn)
        options.append((cost + cut_off + 2, "R" + audit))
        if initial in {"": "u", "s": "u", "u": "a", "a": "u"}[turn]:
            cost, audit = plain_repair(rest, initial)
            options.append((cost + cut_off + 2, "IK" + audit))
        after = "a" if turn == "u" else "u"
        cost, audit = plain_repair(rest, after)
        options.append((cost + cut_off + 4, "IR" + audit))
    cost, audit = plain_repair(rest, turn)
    options.append((cost + 5, "ID" + audit))
    return min(options)


CODES = {"s": 0, "u": 1, "a": 2, "t": 3}


def test_repair_equals_search():
    rng = random.Random(9)
    for _ in range(400):
        rows = tuple((rng.choice("suuuaaat"), rng.choice((0, 0, 0, 1, 2, 3))) for _ in range(rng.randrange(12)))
        assert conversations.repair(bytes(f * 4 + CODES[i] for i, f in rows)) == plain_repair(rows)


def test_long_conversations_repair_like_short_ones():
    rng = random.Random(10)
    part = bytes(rng.choice((1, 2, 13, 14, 5, 10, 3)) for _ in range(20_000))
    cost, audit = conversations.repair(part)
    vectors = [conversations.END_COST]
    for code in reversed(part):
        vectors.append(conversations.step_back(code, vectors[-1]))
    assert cost == vectors[-1][0] and len(audit) >= len(part)
    walk = conversations.Walk(audit, part)
    roles = [r[0] for code in part for r, _ in walk.push({0: "system", 1: "user", 2: "assistant", 3: "tool"}[code & 3], "x")]
    roles += [r[0] for r, _ in walk.inserts()]
    assert re.fullmatch("(s?(ua)+)?", "".join(roles))


def plain_audit(rows, damage=True):
    talks = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20 if damage else 9
        own = talks[conv]
        role, text = role if role is not None else " ", text if text is not None else " "
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        own += [(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    out = {}
    for conv, own in talks.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
        seen, faults = set(), []
        for _, role, text in own:
            bare = text.strip("\x20\t\n\x0b\x0c\r")
            faults.append(1 if not bare else 2 if (role, text) in seen else 3 if bare[-1] not in ".!?" else 0)
            seen.add((role, text))
        initials = [r[1][:1] for r in own]
        turns = [r[0] for r in own if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit = plain_repair(tuple((i if i in ("s", "u", "a") else "t", f) for i, f in zip(initials, faults)))
        lines, state, at = [], "", 0
        for edit in audit:
            turn = {"": "user", "s": "user", "u": "assistant", "a": "user"}[state]
            if edit == "I":
                lines.append(f"{turn}:")
                state = turn[0]
                continue
            if edit != "D":
                role = own[at][1] if edit == "K" else turn
                lines.append(f"{role}:{own[at][2]}")
                state = role[0]
            at += 1
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out[conv] = (gaps, *[faults.count(k) for k in (1, 2, 3)], illegal, cost, audit, digest, lines)
    return out


def odd_talk():
    rng = random.Random(11)
    rows = [(None, None, None, None), (None, 1, "user", "Hi."), (None, None, "user", "Hi."), (1, None, "user", ""), (2, 5, "", "No role.")]
    rows += [(3, 1, "user", "Same."), (3, 1, "user", "Same."), (3, 1, "assistant", "Other"), (3, 9, "system", "Late! \n\x0b"), (4, 2, "tool", "x?")]
    rows += [(10 + c, t, rng.choice(("user", "assistant", "system", "tool")), rng.choice(("Yes.", "No", "Why? ", "x" * 3_000, " ", "\t")))
             for c in range(60) for t in range(rng.randrange(1, 14))]
    return rows


@pytest.mark.parametrize("damage", [True, False])
def test_conversations_equal_plain_version(spark, damage):
    rows = odd_talk()
    df = spark.createDataFrame([(*r, 1, "x", 1, "x") for r in rows], TALK).repartition(6)
    want = plain_audit(rows, damage)
    got = {r["conv_id"]: tuple(r)[1:] for r in conversations.audit_conversations(df, damage).collect()}
    assert got == {k: v[:-1] for k, v in want.items()}
    lines = collections.defaultdict(dict)
    for r in conversations.repaired_conversations(df, damage).collect():
        lines[r["conv_id"]][r["place"]] = f"{r['role']}:{r['text']}"
    assert {k: [v[i] for i in range(len(v))] for k, v in lines.items()} == {k: v[-1] for k, v in want.items() if v[-1]}


def test_one_hot_conversation_crosses_batches(spark):
    rows = [(7, t, ("user", "assistant")[t % 2], f"Text {t}.") for t in range(5_000)]
    df = spark.createDataFrame([(*r, 1, "x", 1, "x") for r in rows], TALK).repartition(4)
    got = conversations.audit_conversations(df).first()
    assert got["cost"] == 0 and got["audit"] == "K" * 5_000
    assert got["repaired_sha256"] == hashlib.sha256("\n".join(f"{r[2]}:{r[3]}" for r in rows).encode()).hexdigest()


def test_empty_tables(spark):
    docs, talk = docs_frame(spark, []), spark.createDataFrame([], TALK)
    results = [sharding.assign_shards(docs), collocations.collocations(docs), conversations.audit_conversations(talk, True), conversations.repaired_conversations(talk)]
    assert [r.count() for r in results] == [0] * 4
