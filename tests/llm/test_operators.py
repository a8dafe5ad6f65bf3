"""Each operator against a plain version, and on odd rows: nulls, empty and long texts, ties, repeats, empty tables, clashing names."""

import hashlib
import os
import random

import numpy as np
import pandas as pd
import pyarrow as pa
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from strata.llm import boilerplate, bpe, jaccard, langid, licenses, mixing, pii, queries, repeats, sketch, support, topk
from tests.llm import brute
from tests.oracle import connect, difference

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")
ODD = [None, "", " \n\t ", "a", "a b c", "word " * 30000, "x" * 70000, "é" * 300, "日本語 テキスト"]


def documents(spark, texts, sources=("s",), langs=("en",)):
    rows = [(i, t, langs[i % len(langs)], sources[i % len(sources)], len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def given(spark):
    return queries.read(spark, SF_DIR, "documents")


def text_of(spark):
    return {r.doc_id: r.text for r in given(spark).collect()}


@pytest.mark.parametrize("name", [n for n, (_, sql) in queries.QUERIES.items() if sql])
def test_matches_sql(spark, name):
    run, sql = queries.QUERIES[name]
    with connect(SF_DIR) as con:
        assert difference(run(spark, SF_DIR), con, sql) is None


def test_clean_columns(spark):
    """Operators that return the input's columns survive columns with the names they use themselves."""
    clash = documents(spark, ["a b\nc"] * 6).select("*", *[F.lit(1).alias(c) for c in ("n_lines", "host", "line", "row_key", "rank", "tokens", "lang_pred", "score", "places", "size")])
    assert boilerplate.drop_boilerplate(clash).count() == 6
    assert set(mixing.mix(clash).columns) == set(clash.columns)
    assert set(bpe.encode(clash, VOCABULARY, public_tokenizers.PATTERN).columns) == set(clash.columns)
    assert set(langid.identify(clash, langid.fit(clash)).columns) == set(clash.columns)


# ------------------------------------------------------------------ 1, repeats


def repeat_cases():
    random.seed(3)
    words = ["".join(random.choices("abcdefgh", k=random.randint(2, 8))) for _ in range(300)]
    say = lambda n: " ".join(random.choices(words, k=n))
    shared = [say(60) for _ in range(3)]
    out = [say(80) for _ in range(6)]
    out += [say(random.randint(0, 30)) + random.choice(shared)[random.randint(0, 60) :] + say(random.randint(0, 30)) for _ in range(40)]
    out += [out[0], out[0][: len(out[0]) // 2] + "!" + out[0][len(out[0]) // 2 :], "a" * 1000, "ab" * 300, shared[0] + shared[0]]
    return out + ODD[:5] + ["é" * 300]


@pytest.mark.parametrize(("most", "crowd"), [(100_000, 4000), (100_000, 2), (3, 4000), (3, 1)])
def test_repeats(spark, monkeypatch, most, crowd):
    """Also where grams are taken for crowded, and divided."""
    monkeypatch.setattr(repeats, "MOST", most)
    monkeypatch.setattr(repeats, "CROWD", crowd)
    texts = repeat_cases()
    got = {r.doc_id: (bytes(r.kept), r.spans) for r in repeats.cut_repeats(documents(spark, texts)).collect()}
    expected = brute.cut_repeats([(t or "").encode() for t in texts])
    for i, (kept, removed, runs) in enumerate(expected):
        if removed:
            assert got[i][0] == kept and len(got[i][1]) == 2 * runs
        else:
            assert i not in got


def test_covered_by_windows_and_by_suffix_arrays():
    """Units too many for one suffix array lose the same bytes; a unit that repeats itself is found, too."""
    units = [t.encode()[:368] for t in repeat_cases() if t and len(t.encode()) >= repeats.LENGTH]
    units += [u[k : k + 215] for u in units for k in (0, 7)]
    for times in ([1] * len(units), [1 + i % 3 for i in range(len(units))]):
        assert repeats.covered(units, times, most=1) == repeats.covered(units, times)


def test_edges_of_a_hot_block_meet_in_no_group(spark, monkeypatch):
    """A block that stands in every text: its edges give a different piece a text, none of which meet the others."""
    monkeypatch.setattr(repeats, "MOST", 20)
    monkeypatch.setattr(repeats, "CROWD", 30)
    seen = []
    whole = repeats._single_windows
    monkeypatch.setattr(repeats, "_single_windows", lambda merged: seen.append(merged) or whole(merged))
    draw = random.Random(6)
    say = lambda n: "".join(draw.choices("abcdefghijklmnop ", k=n))
    block = say(400)
    texts = [say(150) + block + say(150) for _ in range(120)]
    got = {r.doc_id: (bytes(r.kept), len(r.spans) // 2) for r in repeats.cut_repeats(documents(spark, texts)).collect()}
    # By chance texts may share the byte before or after the block.
    expected = brute.cut_repeats([t.encode() for t in texts])
    assert got == {i: (kept, runs) for i, (kept, _, runs) in enumerate(expected)}
    crowds = seen[0].groupBy("job").count()
    assert crowds.count() > 0 and crowds.agg(F.min("count")).first()[0] > 30


def test_repeats_of_equal_rows_and_null_ids(spark):
    text = "".join(random.Random(5).choices("abcdef ", k=500))
    rows = spark.createDataFrame([(1, text), (1, text), (None, text), (None, None)], "doc_id long, text string")
    found = repeats.cut_repeats(rows).collect()
    assert len(found) == 3 and all(bytes(r.kept) == b"" for r in found)
    assert repeats.cut_repeats(rows.limit(0)).count() == 0


def test_maximal_groups():
    array = repeats.SuffixArray([b"xabcdeQ" * 1 + b"1", b"yabcdeR", b"zabcdfS"], least=3)
    groups = {(n, tuple(sorted((int(array.unit[p]), int(array.start[p])) for p in range(a, b + 1)))) for n, a, b, _ in array.maximal(3)}
    assert (5, ((0, 1), (1, 1))) in groups and (4, ((0, 1), (1, 1), (2, 1))) in groups
    assert not any(n == 3 and len(m) == 2 for n, m in groups)  # "bcde" is always preceded by "a"


# ----------------------------------------------------------------- 2, personal data


def test_base_spans(spark):
    random.seed(4)
    pieces = ["a@b.c", "a@b.c_d@e.f", "1.2.3.4", "1.2.3.4.5.6.7.8", "300.1.2.3", "0001.2.3.255", "4111 1111 1111 1111", "4111111111111111", "4111-1111-1111-1112",
              "+1 (988) 555-2485", "+1", "+12", "++49 30 1234567", " ", "x", "@", ".", "-", "9" * 25, "é", "\n", "a.b+c%d@ex-1.org.", "1 2 3"]
    texts = ["".join(random.choices(pieces, k=random.randint(1, 12))) for _ in range(400)] + ODD + ["1" * 50000, "a" * 50000 + "@b.c", "1." * 20000]
    rows = pii.annotated(documents(spark, texts)).collect()
    got = {r.doc_id: [f"{k}:{s.start}:{s.end}" for k in pii.KINDS for s in r[k]] for r in rows}
    for i, t in enumerate(texts):
        assert got[i] == brute.base_spans(t), t


def test_bootstrap_finds_new_identifiers(spark):
    known = [f"Please write mailto: user{i}@site{i}.org today, thing {i % 7} here." for i in range(12)]
    new = ["Please write mailto: bob(at)hidden.org today.", "nothing of note, version 2.0 and bob(at)nowhere too", "plain 12 words"]
    rows = {r.doc_id: r for r in pii.find_pii(documents(spark, known + new)).collect()}
    assert [(s.kind, new[0][s.start : s.end]) for s in rows[12].added] == [("email", "bob(at)hidden.org")]
    assert all(not r.added for i, r in rows.items() if i != 12)
    assert pii.find_pii(documents(spark, ["a@b.c"]).limit(0)).count() == 0


def added_of(spark, texts):
    rows = pii.find_pii(documents(spark, texts)).collect()
    return {r.doc_id: sorted((s.kind, texts[r.doc_id][s.start : s.end]) for s in r.added) for r in rows if r.added}


def test_bootstrap_takes_whole_identifiers(spark):
    texts = [f"Tel: +1 (988) 555-24{i:02d} or later" for i in range(12)]
    texts += ["Tel: (988) 555-7711 or later", "contact: bob at hidden dot org now"]
    texts += [f"contact: user{i}@site.org now" for i in range(6)]
    # A base span inside a longer run, or beside one, is never covered again.
    texts += ["Tel: +1 (988) 555-2400, Tel: (030) 555-1234 or", "Tel: 1.2.3.4 5551234 or"]
    assert added_of(spark, texts) == {
        12: [("phone", "(988) 555-7711")], 13: [("email", "bob at hidden dot org")], 20: [("phone", "(030) 555-1234")],
    }


def test_bootstrap_runs_until_nothing_changes(spark):
    # Each stage's slots are known only by the instances that the stage before it found.
    texts = [f"s0: +49 30 5551{i:03d} e0." for i in range(30)]
    for stage in range(6):
        shared = [f"({stage}{i}0) 555-7{i}{stage}1" for i in range(6)]
        texts += [f"s{stage}: {x} e{stage}." for x in shared] + [f"s{stage + 1}: {x} e{stage + 1}." for x in shared] * 5
    texts += ["s6: (999) 555-0000 e6."]
    found = added_of(spark, texts)
    assert found == brute.bootstrap(texts)
    assert found[len(texts) - 1] == [("phone", "(999) 555-0000")] and len(found) == len(texts) - 30


def test_bootstrap_equals_plain_version(spark):
    random.seed(12)
    words = ["tel:", "card", "mail", "host", "the", "x", "no."]
    things = [lambda: f"+1 (988) 555-{random.randint(0, 30):04d}", lambda: f"(988) 555-{random.randint(0, 30):04d}", lambda: "4111 1111 1111 1111",
              lambda: f"3782 822463 {random.randint(10000, 10020)}", lambda: f"u{random.randint(0, 20)}@a.org", lambda: f"u{random.randint(0, 20)} at a dot org",
              lambda: f"10.0.0.{random.randint(0, 30)}", lambda: f"fe80:0:0:{random.randint(0, 20)}", lambda: str(random.randint(1, 99))]
    usual = {w: [things[2 * i]] * 12 + [things[2 * i + 1]] for i, w in enumerate(words[:4])}
    texts = []
    for _ in range(400):
        parts = []
        for _ in range(random.randint(1, 5)):
            w = random.choice(words)
            parts += [w, random.choice(usual.get(w, things) if random.random() < 0.95 else things)(), random.choice([",", "\n", "and", "é"])]
        texts.append(" ".join(parts))
    found = added_of(spark, [*texts, *texts[:20], None, ""])
    assert found == brute.bootstrap([*texts, *texts[:20], "", ""]) and len(found) > 20


def test_mentions_of_one_long_text(spark):
    n = 100000
    row = pii.find_pii(documents(spark, ["12 x a@b.c y " * n, "a1 " * n])).orderBy("doc_id").collect()[0]
    assert len(row.email) == n and row.email[-1].start == 13 * (n - 1) + 5 and not row.added


# -------------------------------------------------------------------------- 3, mix


def test_mix_meets_targets(spark):
    random.seed(6)
    texts = ["w " * random.randint(0, 50) for _ in range(3000)] + [None, "", "z " * 7, "z " * 7]
    df = documents(spark, texts, sources=["b", "a", None, "b", "b"])
    plan = mixing.copies_plan(df).collect()
    taken, target, size = {}, {}, {}
    for r in plan:
        taken[r.source] = taken.get(r.source, 0) + r.copies * r.size
        target[r.source], size[r.source] = r.target, r.source_size
        assert 0 <= r.copies <= 3
    assert abs(sum(target.values()) - sum(size.values())) < 1e-6
    for s in taken:
        assert target[s] <= 3 * size[s] and abs(taken[s] - target[s]) <= 100
    assert sorted(r.copies for r in plan) == sorted(r.copies for r in mixing.copies_plan(df.repartition(7)).collect())
    mixed = mixing.mix(df)
    assert mixed.columns == df.columns and mixed.count() == sum(r.copies for r in plan)


def test_mix_of_equal_rows_and_nothing(spark):
    rows = spark.createDataFrame([(1, "a b", "x", "s", 3)] * 5 + [(2, "c", "x", None, 1)], "doc_id long, text string, lang string, source string, n_chars long")
    assert mixing.mix(rows).count() == sum(r.copies for r in mixing.copies_plan(rows).collect())
    assert mixing.mix(rows.limit(0)).count() == 0


# ------------------------------------------------------------------------- 4, lines


def test_boilerplate(spark):
    texts = [f"menu\nown line {i}\n\n  foot \r" for i in range(8)] + [None, "", "menu", "x\nfoot"]
    rows = boilerplate.drop_boilerplate(documents(spark, texts)).orderBy("doc_id").collect()
    assert [r.text for r in rows] == [*(f"own line {i}\n" for i in range(8)), None, "", "", "x"]
    assert [(r.n_lines, r.n_dropped) for r in rows[7:]] == [(4, 2), (0, 0), (1, 0), (1, 1), (2, 1)]
    alone = boilerplate.drop_boilerplate(documents(spark, texts, sources=[str(i) for i in range(12)])).select("text").collect()
    assert sorted(r.text or "" for r in alone) == sorted(t or "" for t in texts)  # hosts of one page
    rare = boilerplate.drop_boilerplate(documents(spark, texts), least_pages=10).select("n_dropped").collect()
    assert not any(r.n_dropped for r in rare)
    assert boilerplate.drop_boilerplate(documents(spark, texts).limit(0)).count() == 0


def test_boilerplate_of_small_hosts_and_long_pages(spark):
    two = boilerplate.drop_boilerplate(documents(spark, ["nav\na", "nav\nb"])).orderBy("doc_id").collect()
    assert [r.text for r in two] == ["a", "b"]
    random.seed(5)
    shared = [f"line {i}" for i in range(30000)]
    pages = [random.sample(shared + [f"own {p} {i}" for i in range(20000)], 50000) for p in range(2)]
    got = boilerplate.drop_boilerplate(documents(spark, ["\n".join(p) for p in pages])).orderBy("doc_id").collect()
    assert [r.text for r in got] == ["\n".join(x for x in p if x.startswith("own")) for p in pages]
    assert [r.n_dropped for r in got] == [30000, 30000]
    same = spark.createDataFrame([(1, "a\nb", "s")] * 3 + [(None, "a\nc", "s"), (None, "a\nc", None)], "doc_id long, text string, source string")
    assert sorted(r.text for r in boilerplate.drop_boilerplate(same).collect()) == ["", "", "", "a\nc", "c"]


# ------------------------------------------------------------------------- 5, top-k


def test_topk(spark, monkeypatch):
    monkeypatch.setattr(topk, "GROUP", 1)
    monkeypatch.setattr(topk, "CHUNK", 16)
    rng = np.random.default_rng(1)
    vectors = [[float(x) for x in v] for v in rng.normal(size=(1100, 6)).round(1)]
    vectors[7], vectors[8], vectors[9], vectors[20] = None, [1.0, float("nan")], [], vectors[40]
    df = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>")
    whole = df.select("vec_id", topk.whole_numbers(F.col("embedding")).alias("vector"))
    got = topk.top_k(whole, whole.filter("vec_id % 20 = 0"), 20).collect()
    valid = {i: np.floor(64 * np.array(v)).astype(int) for i, v in enumerate(vectors) if v and not np.isnan(v).any()}
    expected = set()
    for q in (i for i in valid if i % 20 == 0):
        best = sorted((-int(valid[q] @ valid[i]), i) for i in valid if i != q)[:20]
        expected |= {(q, rank + 1, i, -s) for rank, (s, i) in enumerate(best)}
    assert {(r.query_id, r.rank, r.vec_id, r.score) for r in got} == expected and len(got) == len(expected)
    assert topk.top_k(whole.limit(0), whole.limit(0)).count() == 0


def best_rows(rows, k=20):
    """The k best of every query (ids divisible by 20), compared one by one; of a repeated id the smallest vector asks."""
    asked = {}
    for i, v in sorted((i, v) for i, v in rows if i is not None and i % 20 == 0):
        asked.setdefault(i, v)
    out = []
    for q, v in asked.items():
        best = sorted((-sum(a * b for a, b in zip(v, w, strict=False)), i) for i, w in rows if i is not None and i != q)[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    return sorted(out)


@pytest.mark.parametrize("large", [1, 2**20])
def test_topk_of_clusters_repeats_and_large_numbers(spark, monkeypatch, large):
    for name, n in (("BLOCK", 8), ("GROUP", 2), ("CHUNK", 16), ("SUMMARY", 3)):
        monkeypatch.setattr(topk, name, n)
    random.seed(15)
    rows = [(i, [large * (random.randint(-9, 9) + 60 * (i // 40 % 6 == j)) for j in range(6)]) for i in range(500)]
    rows += rows[40:70] + [(40, [1]), (60, [large * 50] * 3), (None, [1, 2])]
    df = spark.createDataFrame(rows, "vec_id long, vector array<long>")
    got = topk.top_k(df, df.filter("vec_id % 20 = 0"), 20).collect()
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got) == best_rows(rows)
    # Fewer rows than k: all of them, from all groups.
    few = df.filter("vec_id < 18")
    assert topk.top_k(few, few.filter("vec_id = 0"), 20).count() == 17
    if large > 1:
        huge = spark.createDataFrame([(0, [2**40]), (1, [2**40])], "vec_id long, vector array<long>")
        with pytest.raises(Exception, match="64 bits"):
            topk.top_k(huge, huge.filter("vec_id = 0")).collect()


def test_topk_skips_blocks_below_the_threshold(monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 4)
    rows = pd.DataFrame({"vec_id": range(40), "vector": [[i // 4, 1] for i in range(40)]})
    query = pd.DataFrame({"vec_id": [-1], "vector": [[1, 0]]})
    found, scored = topk._search(query, rows, 4)
    assert (scored, found["score"].tolist()) == (1, [9] * 4)
    for least, blocks in ((9, 1), (10, 0)):
        assert topk._search(query, rows, 20, np.array([least]))[1] == blocks
    assert topk._search(query, rows, 20)[1] == 5


# ------------------------------------------------------------------------ 6, Jaccard


def near_copies(n=60):
    random.seed(8)
    words = [f"w{i}" for i in range(500)]
    base = [random.choices(words, k=random.randint(3, 120)) for _ in range(n)]
    out = [" ".join(b) for b in base]
    for b in base:
        for _ in range(3):
            changed = list(b)
            for _ in range(random.randint(0, max(1, len(b) // 25))):
                changed[random.randrange(len(changed))] = random.choice(words)
            out.append(" ".join(changed))
    return out


def test_jaccard_join(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "TILE", 8)
    texts = dict(enumerate(near_copies() + [" ".join(f"t{i}" for i in range(60)) + f" end{k}" for k in range(40)] + ODD + ["a b c", "a  b c"]))
    got = jaccard.join_similar(documents(spark, list(texts.values()))).collect()
    expected = brute.jaccard_classes(texts)
    assert len(got) == len(texts)
    assert {r.doc_id: (r.n_links, r.class_id) for r in got} == expected
    assert jaccard.join_similar(documents(spark, ["a"]).limit(0)).count() == 0


def test_components(spark):
    """A long path, a star, a ring, loops and repeated edges, against a plain union of sets."""
    pairs = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 20)] + [(200 + i, 200 + (i + 1) % 9) for i in range(9)]
    pairs += [(300, 301), (301, 300), (300, 301), (400, 400)]
    random.Random(3).shuffle(pairs)
    root = {x: x for pair in pairs for x in pair}
    for _ in root:
        for a, b in pairs:
            root[a] = root[b] = min(root[a], root[b])
    got = jaccard.components(spark.createDataFrame(pairs, "a long, b long")).collect()
    assert len(got) == len({r.node for r in got})
    assert {r.node: r.root for r in got} == {x: y for x, y in root.items() if x != 400}  # a lone loop links nothing
    assert jaccard.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_pruning_tolerance():
    for n, least in jaccard.least_matches():
        assert 0 <= least <= 0.8 * n
    hashes = np.arange(1, 4001, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    a, b = jaccard.signatures(np.concatenate([hashes[:3600], hashes[400:]]), np.array([0, 3600, 7200]))
    assert abs((a == b).mean() - 0.8) < 0.12


# ---------------------------------------------------------------------- 7, language


def test_language_accuracy_on_held_out(spark):
    run, _ = queries.QUERIES["op7_langid"]
    truth = {r.doc_id: r.lang for r in given(spark).collect()}
    rows = run(spark, SF_DIR).collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == len(truth) and all(0 <= r.score <= 1 for r in rows)
    assert sum(truth[r.doc_id] == r.lang_pred for r in held) >= 0.9 * len(held)


def test_language_of_odd_texts(spark):
    df = documents(spark, ["der die das und", "the and of a", None, "", "12 34 !", "the of the " * 2000], langs=["de", "en"])
    model = langid.fit(df.filter("doc_id < 2"))
    got = [r.lang_pred for r in langid.identify(df, model).orderBy("doc_id").collect()]
    assert got == ["de", "en", "und", "und", "und", "en"]
    nothing = langid.fit(df.limit(0))
    assert {r.lang_pred for r in langid.identify(df, nothing).collect()} == {"und"}


# ---------------------------------------------------------------------- 8, licences


def test_jaccard_sends_small_batches(spark, monkeypatch):
    """Texts, shingle sets and partners reach Python a bounded number of rows at once; the session's setting comes back."""
    name, plain, seen = "spark.sql.execution.arrow.maxRecordsPerBatch", jaccard.settle, []

    def settled(df):
        if "MapInArrow" in df._jdf.queryExecution().optimizedPlan().toString():
            seen.append(int(spark.conf.get(name)))
        return plain(df)

    before = spark.conf.get(name)
    monkeypatch.setattr(jaccard, "settle", settled)
    texts = dict(enumerate(near_copies()))
    got = {r.doc_id: r for r in jaccard.join_similar(documents(spark, list(texts.values()))).collect()}
    assert {i: r.class_id for i, r in got.items()} == {i: root for i, (_, root) in brute.jaccard_classes(texts).items()}
    assert len(seen) == 3 and max(seen) <= jaccard._ROWS and spark.conf.get(name) == before
    with support.small_batches(spark, 10**9):
        assert spark.conf.get(name) == before


def test_licenses(spark):
    plain = [f"some ordinary words about topic {i} and more of {i * 7}\nanother line {i}" for i in range(60)]
    texts = [*plain, "text\nReleased under the MIT License.", "Licensed under CC BY-NC 4.0.", "Licensed under some other terms entirely", *ODD[:5]]
    rows = licenses.find_licenses(documents(spark, texts)).collect()
    got = {r.doc_id: [(n.family, n.line) for n in r.notices] for r in rows}
    assert got[60] == [("MIT", 1)] and got[61] == [("CC-BY-NC", 0)]
    assert not any(v for i, v in got.items() if i not in (60, 61))
    assert len(rows) == len(texts)


def test_many_notices_in_one_text(spark):
    """A sentence counts by its own lines, or as a whole."""
    lines = "Released under the MIT License.\nLicensed under the MIT license\nReleased under the BSD License\n\n" * 1000
    split = "Released under the\nMIT License.\n\n"
    rows = licenses.find_licenses(documents(spark, [lines, split, "plain words\n" * 50])).collect()
    got = {r.doc_id: [(n.family, n.line) for n in r.notices] for r in rows}
    assert got[0] == [(family, 4 * i + k) for i in range(1000) for k, family in enumerate(("MIT", "MIT", "BSD"))]
    assert [f for f, _ in got[1]] == ["MIT"] and got[2] == []


def test_wrapped_licenses(spark):
    bsd = "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are met:"
    style = "# Copyright 2020 The Authors\n#\n# Use of this source code is governed by a BSD-style\n# license that can be found in the LICENSE file.\n\npackage main"
    lgpl = " * This library is free software; you can redistribute it and/or\n * modify it under the terms of the GNU Lesser General Public\n * License as published by the Free Software Foundation; either\n * version 2.1 of the License, or (at your option) any later version."
    gpl = "// This program is free software: you can redistribute it and/or modify\n// it under the terms of the GNU General Public License as published by\n// the Free Software Foundation, either version 3 of the License, or\n// (at your option) any later version."
    mpl = "Some words. This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy of the MPL was not distributed with this\nfile, You can obtain one elsewhere."
    plain = [f"Some ordinary words about topic {i} and\nmore of {i * 7}. Another line {i}\n\nand a block {i}" for i in range(60)]
    texts = [*plain, bsd, style, f"/*\n{lgpl}\n */\nint main;", f"Some heading\n{gpl}", mpl, "Heading\nReleased under the MIT License\nAnother heading\nReleased under the MIT License"]
    rows = {r.doc_id: r for r in licenses.find_licenses(documents(spark, texts)).collect()}
    got = [[(n.family, n.line) for n in rows[i].notices] for i in range(60, 66)]
    assert got == [[("BSD", 0)], [("BSD", 2)], [("LGPL", 1)], [("GPL", 1)], [("MPL-2.0", 0)], [("MIT", 1), ("MIT", 3)]]
    assert not any(rows[i].notices for i in range(60))
    assert [rows[i].n_paragraphs for i in (0, 60, 61, 62)] == [2, 1, 3, 2]


# Wordings that are no template as they stand, and what they are.
KEPT_BACK = [
    ("MIT", "Distributed under the MIT license."), ("MIT", "This project is MIT licensed."), ("MIT", "The code is MIT licensed, see LICENSE."),
    ("MIT", "This project is licensed under the MIT License - see the LICENSE file for details."), ("MIT", "// SPDX-License-Identifier: MIT"),
    ("MIT", "Released under the MIT license by its authors."), ("Apache-2.0", "Licensed under Apache 2.0."),
    ("Apache-2.0", "# SPDX-License-Identifier: Apache-2.0"), ("Apache-2.0", "This software is licensed under the Apache 2.0 license."),
    ("Apache-2.0", "It is distributed under the terms of the Apache License 2.0."), ("BSD", "This package is licensed under the BSD 3-Clause license."),
    ("BSD", "Distributed under the BSD License."), ("BSD", "/* SPDX-License-Identifier: BSD-3-Clause */"), ("GPL", "It may be used under the terms of the GNU GPL v3."),
    ("GPL", "This tool is licensed under the GPLv3 license."), ("GPL", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("LGPL", "This library is licensed under the GNU LGPL v3 license."), ("LGPL", "SPDX-License-Identifier: LGPL-2.1-only"),
    ("MPL-2.0", "The sources are licensed under MPL 2.0."), ("MPL-2.0", "SPDX-License-Identifier: MPL-2.0"),
    ("ISC", "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided the notice stays."),
    ("ISC", "This module is ISC licensed."), ("Unlicense", "This is free and unencumbered software released into the public domain, as is."),
    ("EPL-2.0", "Licensed under the EPL 2.0 license."), ("CC-BY", "The photographs are licensed under a Creative Commons Attribution 4.0 International License."),
]
# Sentences that speak of licences without being a notice.
NO_NOTICE = [
    "The driver lost his license after the accident.", "They released the prisoners under the terms of the treaty.", "A license to fish is required here.",
    "He is licensed to practise medicine.", "MIT is a university.", "The project is under way.", "All permission was granted by the mayor.",
]


def test_license_wordings(spark):
    plain = [f"Some ordinary words about topic {i} and more of {i * 7}. Another sentence {i}" for i in range(60)]
    texts = [*plain, *[f"Heading\n\n{t}\n\nMore words follow" for _, t in KEPT_BACK], *NO_NOTICE]
    rows = {r.doc_id: {n.family for n in r.notices} for r in licenses.find_licenses(documents(spark, texts)).collect()}
    found = [family in rows[60 + i] for i, (family, _) in enumerate(KEPT_BACK)]
    wrong = [i for i in rows if (i < 60 or i >= 60 + len(KEPT_BACK)) and rows[i]]
    assert sum(found) >= 0.9 * len(found), [t for ok, (_, t) in zip(found, KEPT_BACK, strict=True) if not ok]
    assert not wrong


def test_licenses_learn_from_all_candidates(spark):
    """Every different candidate that is judged trains the unknown class, however many there are; copies count once."""
    texts = [f"Words under topic {i} and more. They released item {i} of the series" for i in range(3500)]
    docs = documents(spark, [*texts, *texts[:50], "Released under the MIT License."])
    ordinary = licenses._ordinary(licenses.candidates(docs))
    assert ordinary.count() == 7000
    rows = licenses.find_licenses(docs).filter("size(notices) > 0").collect()
    assert [(r.doc_id, [n.family for n in r.notices]) for r in rows] == [(3550, ["MIT"])]


def test_licenses_train_on_partitions_by_rows(spark, monkeypatch):
    """A pass shuffles a partial gradient a partition: shuffle partitions must not set their number."""
    seen = []

    class Seen(licenses.LogisticRegression):
        def fit(self, rows):
            seen.append((rows.rdd.getNumPartitions(), rows.count()))
            return super().fit(rows)

    monkeypatch.setattr(licenses, "LogisticRegression", Seen)
    docs = documents(spark, [f"His license number {i} was renewed in town {i}." for i in range(200)])
    names = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in names}
    try:
        for k, v in names.items():
            spark.conf.set(k, v)
        found = licenses.settle(licenses.candidates(docs))
        licenses.train(found)
        monkeypatch.setattr(licenses, "_GRADIENT_ROWS", 300)
        licenses.train(found)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    (one, n), (more, m) = seen
    assert n == m > 400  # every candidate, plain and behind an example
    assert (one, more) == (1, -(-n // 300))


def test_licenses_of_odd_tables(spark):
    """An empty table, and repeated rows, which each keep their notice."""
    assert licenses.find_licenses(documents(spark, []).limit(0)).count() == 0
    twice = documents(spark, ["Released under the MIT License."]).unionAll(documents(spark, ["Released under the MIT License."]))
    assert [[n.family for n in r.notices] for r in licenses.find_licenses(twice).collect()] == [["MIT"]] * 2


def test_telling_words():
    """Candidates without them could not agree with any template."""
    told = set(licenses.telling_words())
    for t in sum(licenses.TEMPLATES.values(), []):
        triples = licenses._triples(t)
        assert sum(told.isdisjoint(x.split()) for x in triples) < licenses.AGREE * len(triples)


# --------------------------------------------------------------------- 9, tokens


def test_bpe_equals_the_library(spark):
    ranks = bpe.read_ranks(VOCABULARY)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = [*text_of(spark).values(), *ODD, "<|endoftext|>", "don't 'LL", "a   b", "aaaa" * 500, "\U0001f600" * 40]
    df = documents(spark, texts)
    rows = bpe.decode(bpe.encode(df, VOCABULARY, public_tokenizers.PATTERN), VOCABULARY, public_tokenizers.PATTERN).collect()
    both = {r.doc_id: bytes(r.decoded) for r in bpe.encode(df, VOCABULARY, public_tokenizers.PATTERN, decoded=True).collect()}
    for r in rows:
        assert np.frombuffer(bytes(r.tokens), "<u4").tolist() == library.encode_ordinary(r.text or "")
        assert bytes(r.decoded) == (r.text or "").encode() == both[r.doc_id]
    assert bpe.encode(df.limit(0), VOCABULARY, public_tokenizers.PATTERN).count() == 0


# ----------------------------------------------------------------- 10, fingerprints


def test_fingerprints(spark):
    run, _ = queries.QUERIES["op10_fingerprints"]
    texts = text_of(spark)
    ids = sorted(texts)
    rows = {r.doc_id: r for r in run(spark, SF_DIR).collect()}
    assert sorted(rows) == ids
    for i, d in enumerate(ids):
        text, after = texts[d] or "", texts[ids[(i + 1) % len(ids)]] or ""
        k = len(text) // 4
        edited = text[: len(text) - k] + after[:k]
        assert rows[d].n_chars == len(text)
        assert rows[d].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        own, other = sketch.of_texts([text, edited])
        assert rows[d].fingerprint == sketch.written(own) and rows[d].edited_fingerprint == sketch.written(other)
        assert rows[d].near_edited == pytest.approx(sketch.likeness(own, other))


def test_likeness_estimates_containment(spark):
    words = [f"w{i}" for i in range(20000)]
    whole, part, other = (" ".join(w) for w in (words, words[3000:6000], words[::-1]))
    a, b, c = sketch.of_texts([whole, part, other])
    assert sketch.likeness(a, b) > 0.95 and sketch.likeness(a, c) == 0
    shown = spark.createDataFrame([(sketch.written(a), sketch.written(b), sketch.written(c))], "a string, b string, c string")
    row = shown.select(sketch.contained(F.col("a"), F.col("b")).alias("ab"), sketch.contained(F.col("a"), F.col("c")).alias("ac")).first()
    assert row.ab == pytest.approx(sketch.likeness(a, b)) and row.ac == 0


def test_merged_sketches_are_those_of_both_sets(spark):
    random.seed(6)
    sizes = [0, 5, 9, 16, 30, 200, 600, 3000]
    hashes = [np.array([random.getrandbits(64) for _ in range(n)], np.uint64) for n in sizes]

    def direct(values):
        values, line = np.unique(values), np.uint64(int(sketch.FRACTION * 2**64) - 1)
        low = values[values <= line]
        if len(low) >= sketch.FLOOR:
            return np.concatenate([[line], low])
        top = np.uint64(2**64 - 1) if len(values) <= sketch.FLOOR else values[sketch.FLOOR - 1]
        return np.concatenate([[top], values[: sketch.FLOOR]])

    pairs = [(a, b, direct(np.concatenate([a, b]))) for a in hashes for b in [*hashes, hashes[3][:4]]]
    for a, b, both in pairs:
        assert sketch.united(direct(a), direct(b)).tolist() == both.tolist()
    shown = spark.createDataFrame([tuple(sketch.written(x) for x in (direct(a), direct(b), both)) for a, b, both in pairs], "a string, b string, both string")
    assert shown.filter(sketch.merged(F.col("a"), F.col("b")) != F.col("both")).count() == 0
    texts = [" ".join(f"w{random.randint(0, 400)}" for _ in range(n)) for n in (900, 3, 40)]
    words = [t.split() for t in texts]
    for text, w in zip(texts, words, strict=True):  # a sketch against the shingles' own hashes, one by one
        own = [sketch.shingles(*sketch.text_bytes(pa.array([" ".join(w[i : i + 5])])))[0][0] for i in range(max(1, len(w) - 4))]
        assert sketch.of_texts([text])[0].tolist() == direct(np.array(own, np.uint64)).tolist()


def test_fingerprints_of_odd_rows(spark):
    rows = sketch.compare_edited(documents(spark, ODD)).collect()
    assert len(rows) == len(ODD) and all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    alone = sketch.compare_edited(documents(spark, ["one two three four five six"])).collect()
    assert alone[0].near_next == 1.0
    same = spark.createDataFrame([(1, "b c"), (1, "a b"), (None, "x"), (None, None)], "doc_id long, text string")
    assert sketch.compare_edited(same).count() == 4
    assert sketch.compare_edited(same.limit(0)).count() == 0
    assert [r.fingerprint for r in sketch.fingerprints(same).collect()][0]
