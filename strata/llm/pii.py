"""Personal data: exact base patterns, and a bootstrap over contexts for what they miss.

Base spans are the leftmost non-overlapping matches of four patterns (``PATTERNS``) that
pass their check. They are the seeds of the bootstrap:

1. Mentions. Runs that look like an identifier (``_MENTION``: addresses, also written out as
   ``name at host dot org``, colon groups, runs of digits with blanks, brackets, dots and hyphens
   between) are taken from all texts with the word before and the word after the whole run. A
   mention that is a base match as it stands is a seed of its kind; others may become an
   instance of the kinds whose shape they have (``_shaped``), such as a national phone number.
2. Patterns. A lexical pattern is a kind and the word before, or the word after, an instance.
   Its confidence is the weight of known instances in its slot, divided by all mentions, of any
   shape, in that slot.
3. Rounds. Patterns are scored from instances, and instances from patterns (1 - the product of
   (1 - confidence)), over the graph of patterns and instances with counts on its edges, until
   a round changes nothing. Scores only grow, so that this ends; ``MOST_ROUNDS`` is a guard
   that raises. Patterns need ``LEAST_PATTERN`` and ``LEAST_SEEDS`` different instances, new
   instances ``LEAST_INSTANCE``.
4. Mentions of accepted instances that stand in the slot of an accepted pattern, and touch no
   base span, become spans of the pattern's kind.

Everything is SQL functions. The work grows with the text: places are running sums over blocks
of ``_BLOCK`` lengths, and base spans meet mentions in the order of their starts. Mentions of
one slot are counted with partial aggregates. Offsets are code points, ends exclusive.

Rows: null text is empty. Repeated rows are found alike. Null ids are allowed. Extra columns
are not read. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.support import settle

KINDS = ("email", "ip", "card", "phone")
# The patterns to match, written without backtracking. A match may start after the last one
# (\G) or where its first run of characters starts; elsewhere it would have started before.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_AT = r"(?:\x20?[(\[]at[)\]]\x20?|\x20at\x20)"
_DOT = r"(?:\.|\x20?[(\[]dot[)\]]\x20?|\x20dot\x20)"
_HOST = r"[A-Za-z0-9-]++"
_ADDRESS = rf"[A-Za-z0-9._%+-]++(?:@{_HOST}(?:{_DOT}{_HOST})*+|{_AT}{_HOST}(?:{_DOT}{_HOST})++)"
_COLONS = r"[0-9A-Fa-f]{0,4}(?::[0-9A-Fa-f]{0,4}){3,7}+(?![A-Za-z0-9:])"
_NUMBER = r"\+?+\(?+[0-9](?:[\x20().-]{0,2}+[0-9])*+(?![A-Za-z0-9])"
_MENTION = rf"(?:(?<![A-Za-z0-9._%+-]){_ADDRESS}|(?<![A-Za-z0-9])(?:{_COLONS}|{_NUMBER}))"
LEAST_PATTERN = 0.5
LEAST_INSTANCE = 0.8
LEAST_SEEDS = 5
MOST_ROUNDS = 50
_EDGES = ".,;:!?\"'()[]<>{}"
_BLOCK = 64
_SPANS = "array<struct<found:string,start:int,end:int,before:string,after:string>>"


def _with(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once, also where ``use`` names it in a lambda."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _sums(lengths: Column) -> Column:
    """The sums of the first 0, 1, ... n numbers; its time grows with the square of n."""
    return F.aggregate(
        lengths, F.array(F.lit(0)), lambda done, x: F.concat(done, F.array(F.element_at(done, -1) + x))
    )


def _running(lengths: Column, levels: int = 2) -> Column:
    """The sum before each number. Blocks are summed apart and moved by the sums of the blocks."""
    if not levels:
        return _with(_sums(lengths), lambda sums: F.slice(sums, 1, F.size(sums) - 1))

    def blocks(all_of: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(all_of), F.lit(_BLOCK))
        return F.transform(starts, lambda i: _sums(F.slice(all_of, i, _BLOCK)))

    def moved(parts: Column) -> Column:
        before = _running(F.transform(parts, lambda p: F.element_at(p, -1)), levels - 1)
        return F.flatten(
            F.zip_with(parts, before, lambda p, ahead: F.transform(F.slice(p, 1, F.size(p) - 1), lambda x: x + ahead))
        )

    none = F.array().cast("array<int>")
    return _with(lengths, lambda all_of: F.when(F.size(all_of) > 0, _with(blocks(all_of), moved)).otherwise(none))


def _matches(text: Column, pattern: str, context: bool = False) -> Column:
    """Structs of match, start and end, with the words around if asked. Splitting at the pattern gives what lies between."""

    def places(both: Column) -> Column:
        found, between = both["found"], both["between"]
        lengths = F.transform(found, lambda f, i: F.length(F.get(between, i)) + F.length(f))

        def one(f: Column, i: Column, before: Column) -> Column:
            start = before + F.length(F.get(between, i))
            words = (_last_word(F.get(between, i)), _first_word(F.get(between, i + 1))) if context else ()
            named = [w.alias(n) for w, n in zip(words, ("before", "after"), strict=False)]
            return F.struct(f.alias("found"), start.alias("start"), (start + F.length(f)).alias("end"), *named)

        return _with(_running(lengths), lambda ahead: F.transform(found, lambda f, i: one(f, i, F.get(ahead, i))))

    between = F.split(text, pattern, -1)
    found = F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1))
    return _with(F.struct(between.alias("between"), found.alias("found")), places)


def _digits(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def _valid(kind: str, found: Column) -> Column:
    if kind == "ip":
        return F.forall(
            F.split(found, r"\."),
            lambda p: (F.length(F.ltrim(p, F.lit("0"))) <= 3) & (F.lpad(F.ltrim(p, F.lit("0")), 3, "0") <= F.lit("255")),
        )
    if kind == "card":
        return F.length(_digits(found)).between(16, 19) & F.call_function("luhn_check", _digits(found))
    if kind == "phone":
        return F.length(_digits(found)).between(8, 15)
    return F.lit(True)


def _could_hold(kind: str, text: Column) -> Column:
    """A cheap test that texts without the kind fail."""
    if kind == "email":
        return F.contains(text, F.lit("@"))
    return F.contains(text, F.lit("+")) if kind == "phone" else F.regexp_like(text, F.lit("[0-9]"))


def base_spans(text: Column, kind: str) -> Column:
    """Structs of found, start and end of one kind, in order of start."""
    none = F.array().cast("array<struct<found:string,start:int,end:int>>")
    found = F.filter(_matches(text, PATTERNS[kind]), lambda m: _valid(kind, m["found"]))
    return F.when(_could_hold(kind, text), found).otherwise(none)


def _last_word(gap: Column) -> Column:
    near = F.rtrim(F.translate(F.right(gap, F.lit(60)), "\n\t\r", "   "))
    return _bare(F.substring_index(near, " ", -1))


def _first_word(gap: Column) -> Column:
    near = F.ltrim(F.translate(F.left(gap, F.lit(60)), "\n\t\r", "   "))
    return _bare(F.substring_index(near, " ", 1))


def _bare(word: Column) -> Column:
    return F.lower(F.btrim(word, F.lit(_EDGES)))


def _mentions(text: Column) -> Column:
    """Identifier-like runs with their place and the words around them (lower case, without punctuation)."""
    held = F.regexp_like(text, F.lit(r"[0-9@]|[\x20(\[]at[\x20)\]]"))
    return F.when(held, _matches(text, _MENTION, context=True)).otherwise(F.array().cast(_SPANS))


def _is_base(kind: str, found: Column) -> Column:
    """Whether a run is a base match of the kind as a whole."""
    first = F.get(F.regexp_extract_all(found, F.lit(f"({PATTERNS[kind]})"), F.lit(1)), F.lit(0))
    return F.coalesce((first == found) & _valid(kind, found), F.lit(False))


def _shaped(kind: str, found: Column) -> Column:
    """Whether a run may be an identifier of the kind although it is no base match."""
    full = {
        "email": _ADDRESS,
        "ip": r"[0-9a-fA-F]{0,4}(?::[0-9a-fA-F]{0,4}){3,7}",
        "card": r"[0-9]{4}(?:[\x20-]?[0-9]){9,11}",
        "phone": r"\(?[0-9]{2,4}\)?[0-9().\x20-]{5,14}",
    }[kind]
    fits = (F.length(found) <= 320) & F.regexp_like(found, F.lit(f"^(?:{full})$"))
    if kind == "phone":
        return fits & F.length(_digits(found)).between(7, 12)
    return fits


def annotated(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, row`` (a number of the row), base spans by kind, and mentions; no shuffle."""
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    return df.select(F.col(f"`{doc_id}`").alias("doc_id"), body.alias("body")).select(
        "doc_id", F.monotonically_increasing_id().alias("row"),
        *[base_spans(F.col("body"), k).alias(k) for k in KINDS], _mentions(F.col("body")).alias("mentions"),
    )


def _slots(mentions: DataFrame) -> DataFrame:
    """One row for each mention and side: the columns of ``mentions`` but ``before`` and ``after``, and ``side, word``."""
    sides = F.array(*[F.struct(F.lit(s).alias("side"), F.col(s).alias("word")) for s in ("before", "after")])
    rest = [c for c in mentions.columns if c not in ("before", "after")]
    return mentions.select(*rest, F.explode(sides).alias("s")).select(*rest, "s.side", "s.word").filter("word <> ''")


def bootstrap(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Accepted ``(kind, side, word)`` patterns and ``(kind, token)`` new instances, with their scores.

    ``rows`` is an annotated table.
    """
    found = rows.select(F.inline("mentions"))
    known = F.coalesce(*[F.when(_is_base(k, F.col("found")), F.lit(k)) for k in KINDS])
    shaped = F.array_compact(F.array(*[F.when(_shaped(k, F.col("found")), F.lit(k)) for k in KINDS]))
    kinds = F.when(known.isNotNull(), F.array(known)).otherwise(shaped)
    # A mention without a kind only counts in its slot.
    token = F.when(F.size("kinds") > 0, F.lower("found"))
    slots = _slots(found.select("found", "before", "after", known.isNotNull().alias("seed"), kinds.alias("kinds")))
    slots = slots.select("side", "word", "seed", "kinds", token.alias("token"))
    # The graph: how often a pattern and an instance occur together.
    slots = settle(slots.groupBy("side", "word", "token", "kinds", "seed").agg(F.count(F.lit(1)).alias("n")))
    places = slots.groupBy("side", "word").agg(F.sum("n").alias("places"))
    edges = slots.select("side", "word", "token", "seed", "n", F.explode("kinds").alias("kind"))
    edges = edges.groupBy("kind", "side", "word", "token").agg(F.sum("n").alias("n"), F.max("seed").alias("seed"))
    edges = settle(edges.join(places, ["side", "word"]))

    seeds = edges.filter("seed").select("kind", "token", F.lit(1.0).alias("score")).distinct()
    instances, before = seeds, None
    for _ in range(MOST_ROUNDS):
        scored = edges.join(instances, ["kind", "token"]).groupBy("kind", "side", "word").agg(
            (F.sum(F.col("n") * F.col("score")) / F.max("places")).alias("confidence"), F.count(F.lit(1)).alias("support")
        )
        patterns = settle(scored.filter((F.col("confidence") >= LEAST_PATTERN) & (F.col("support") >= LEAST_SEEDS)))
        new = edges.join(patterns, ["kind", "side", "word"]).join(seeds, ["kind", "token"], "left_anti").groupBy("kind", "token").agg(
            (1 - F.exp(F.sum(F.log(F.greatest(1 - F.col("confidence"), F.lit(1e-9)))))).alias("score")
        )
        new = settle(new.filter(F.col("score") >= LEAST_INSTANCE))
        state = new.agg(F.count(F.lit(1)), F.round(F.coalesce(F.sum("score"), F.lit(0.0)), 6)).first()
        if not state[0] or state == before:
            return patterns, new
        before, instances = state, seeds.union(new.select("kind", "token", "score"))
    raise RuntimeError(f"patterns and instances still change after {MOST_ROUNDS} rounds")


def _clear_of_base(hits: DataFrame, rows: DataFrame) -> DataFrame:
    """The hits (``row, kind, start, end``) that touch no base span of their text, met in order of start."""
    base = rows.join(hits.select("row").distinct(), "row", "left_semi").select("row", F.explode(F.concat(*KINDS)).alias("b"))
    nothing = F.lit(None).cast("int")
    both = hits.select("row", "kind", "start", "end", nothing.alias("b_start"), nothing.alias("b_end")).union(
        base.select("row", F.lit(None).cast("string"), "b.start", "b.end", "b.start", "b.end")
    )
    up, down = Window.partitionBy("row").orderBy("start"), Window.partitionBy("row").orderBy(F.desc("start"))
    both = both.withColumn("ended", F.max("b_end").over(up)).withColumn("starts", F.min("b_start").over(down))
    clear = (F.coalesce("ended", F.lit(0)) <= F.col("start")) & F.coalesce(F.col("starts") >= F.col("end"), F.lit(True))
    return both.filter(F.col("kind").isNotNull() & clear).select("row", "kind", "start", "end")


def find_pii(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, base spans by kind (arrays of found, start, end), and ``added`` (kind, start, end)."""
    rows = settle(annotated(df, doc_id, text))
    patterns, instances = bootstrap(rows)
    mentions = rows.select("row", F.inline("mentions")).withColumn("token", F.lower("found"))
    hits = _slots(mentions.join(instances.select("kind", "token"), "token").select("row", "kind", "start", "end", "before", "after"))
    hits = hits.join(patterns.select("kind", "side", "word"), ["kind", "side", "word"], "left_semi")
    clear = _clear_of_base(hits.select("row", "kind", "start", "end").distinct(), rows)
    added = clear.groupBy("row").agg(F.collect_set(F.struct("kind", "start", "end")).alias("added"))
    none = F.array().cast("array<struct<kind:string,start:int,end:int>>")
    return rows.join(added, "row", "left").select("doc_id", *KINDS, F.coalesce("added", none).alias("added"))


def span_text(kind: Column, start: Column, end: Column) -> Column:
    return F.concat_ws(":", kind, start.cast("string"), end.cast("string"))
