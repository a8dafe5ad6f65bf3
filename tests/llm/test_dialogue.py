"""Conversation repair against a search over all edits, and on odd rows."""

import hashlib
import itertools
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from strata.llm import dialogue

ROWS = "conv_id long, turn long, role string, text string"
FORM = re.compile("(s?(ua)+)?")


def search(rows):
    """(cost, letters, lines) of the best edits, by trying all: rows are (role, text, must go, truncated)."""
    best = None
    most = 2 * len(rows) // 5
    per_row = []
    for role, text, gone, cut in rows:
        options = [("D", 2, None)]
        if not gone:
            options.append(("K", 5 * cut, f"{role}:{text}"))
            options += [("R", 1 + 5 * cut, f"{name}:{text}") for name in ("user", "assistant")]
        per_row.append(options)
    gaps = [[g for n in range(min(2, most) + 1) for g in itertools.product(("user:", "assistant:"), repeat=n)]] * (len(rows) + 1)
    for edits in itertools.product(*per_row):
        for inserts in itertools.product(*gaps):
            if sum(map(len, inserts)) > most:
                continue
            letters, lines, cost = "", [], 5 * sum(map(len, inserts))
            for gap, edit in itertools.zip_longest(inserts, edits):
                letters += "I" * len(gap)
                lines += gap
                if edit:
                    letters += edit[0]
                    cost += edit[1]
                    if edit[2] is not None:
                        lines.append(edit[2])
            if FORM.fullmatch("".join(line[0] if line[0] != ":" else "x" for line in lines)):
                best = min(x for x in (best, (cost, letters, tuple(lines))) if x)
    return best


def faults(rows):
    """(role, text, must go, truncated) and the counts of blank, duplicate and truncated rows."""
    seen, out, counts = set(), [], [0, 0, 0]
    for role, text in rows:
        core = text.rstrip(" \t\n\x0b\x0c\r")
        again = (role, text) in seen
        seen.add((role, text))
        cut = bool(core) and core[-1] not in ".!?"
        out.append((role, text, not core or again, cut))
        counts[0] += not core
        counts[1] += bool(core) and again
        counts[2] += cut and not again
    return out, counts


def random_conversations(n, most):
    rng = random.Random(7)
    roles = ["user", "assistant", "system", "tool", "", "umpire", "Assistant"]
    texts = ["a.", "b!", "cut", " ", "", "c? \n", "é…"]
    return [[(rng.choice(roles[:3] * 3 + roles), rng.choice(texts)) for _ in range(rng.randint(0, most))] for _ in range(n)]


def test_cheapest_edits():
    for rows in random_conversations(250, 4):
        marked, _ = faults(rows)
        cost, letters, _ = search(marked)
        kinds = [dialogue.BLANK if not t.strip() else dialogue.CUT if c else dialogue.CLEAN for _, t, _, c in marked]
        initials = "".join(r[:1] or "x" for r, *_ in marked)
        assert dialogue.cheapest(initials, kinds, [g for *_, g, _ in marked]) == (cost, letters), rows


def test_conversations(spark):
    talks = random_conversations(60, 4)
    rows = [(n, i, r, t) for n, talk in enumerate(talks) for i, (r, t) in enumerate(talk)]
    df = spark.createDataFrame(rows, ROWS).repartition(5)
    found = {r.conv_id: r for r in dialogue.judged(df).collect()}
    texts = {}
    for r in sorted(dialogue.repaired(df).collect(), key=lambda r: (r.conv_id, r.place)):
        texts.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    for n, talk in enumerate(talks):
        if not talk:
            assert n not in found
            continue
        marked, counts = faults(talk)
        cost, letters, lines = search(marked)
        got = found[n]
        assert (got.cost, got.audit, [got.blank, got.duplicate, got.truncated]) == (cost, letters, counts)
        initials = [r[:1] for r, _ in talk]
        assert got.illegal == sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials)) and got.gaps == 0
        assert got.repaired_sha256 == hashlib.sha256("\n".join(lines).encode()).hexdigest()
        assert texts.get(n, []) == list(lines)


def test_odd_rows(spark):
    rows = [
        (1, None, "user", "first."), (1, 3, "assistant", "x" * 300_000 + "."), (1, 7, "user", "bye."),
        (None, 0, "user", "a."), (None, 1, "assistant", "b."), (None, 2, None, "c."),
        (2, None, None, None), (3, 0, "user", "t."), (3, 0, "user", "t."), (3, 0, "user", "t."),
        (4, None, "user", "only."), (4, None, "assistant", "two."),
    ]
    df = spark.createDataFrame(rows, ROWS).withColumns({c: F.lit("clash") for c in ("key", "mark", "part", "place", "copies")})
    got = {r.conv_id: r for r in dialogue.judged(df).collect()}
    assert set(got) == {1, None, 2, 3, 4}
    assert (got[1].gaps, got[1].audit, got[1].cost) == (3, "KKD", 2)
    assert (got[None].audit, got[None].cost, got[None].illegal) == ("KKD", 2, 1)
    assert (got[2].blank, got[2].audit, got[2].gaps) == (1, "D", 0)
    assert (got[3].duplicate, got[3].audit, got[3].cost) == (2, "DDD", 6) and got[3].illegal == 2
    assert got[4].gaps == 0 and got[4].audit in ("KK", "RR")  # equal turns stand by digest
    assert got[2].repaired_sha256 == hashlib.sha256(b"").hexdigest()
    assert dialogue.judged(df.limit(0)).count() == 0 and dialogue.repaired(df.limit(0)).count() == 0


def test_dropped_rows_name_their_conversation(spark):
    df = spark.createDataFrame([(5, 0, "user", "a.")], ROWS)
    got = dialogue.judged(df, F.lit(0)).first()
    assert (got.conv_id, got.cost, got.audit, got.gaps) == (5, 0, "", 0)
    assert got.repaired_sha256 == hashlib.sha256(b"").hexdigest()


@pytest.mark.parametrize("rows", [2000])
def test_long_conversation(rows):
    """Alternating roles with a system row in the middle: time grows with the square, seconds at thousands."""
    initials = "ua" * (rows // 2)
    start = time.perf_counter()
    cost, letters = dialogue.cheapest("s" + initials + "s" + initials, [0] * (2 * rows + 2), [False] * (2 * rows + 2))
    assert cost == 2 and letters.count("D") == 1 and letters.count("K") == 2 * rows + 1
    assert time.perf_counter() - start < 30
