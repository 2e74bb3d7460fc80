"""Secret scan: fixed patterns plus sliding-window entropy (operator 2).

Fixed patterns give the base spans. Beyond them, every long run of token
characters is a candidate, but for the base spans and the words of the
allow-list in it, which are cut out; what lies between them is judged as runs
of their own. A run's maximal stretches of each character class (hex,
alphanumeric, token) are judged on their own, each with the entropy threshold
of its class, so a prefix or separator does not change the threshold of what
follows it. The Shannon entropy of each window of ``window`` characters is
followed by incremental counts (one character enters, one leaves). The span
from the first window at or above its threshold to the end of the last such
window of the run is reported; stretches on the allow-list have none, and a
single word only while its entropy is below a bound. Only SQL
functions are used; the work on windows is done for candidates alone.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty

# kind: (pattern, group that must be long enough, its least length); in report order
BASE_KINDS = {
    "assign": (r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    "access": (r"AKIA[A-Z0-9]+", 0, 20),
    "hex": (r"[0-9a-f]+", 0, 24),
}
# where a run shorter than the least length can be skipped without changing what follows
RUN_PATTERNS = {"access": r"AKIA[A-Z0-9]{16,}", "hex": r"[0-9a-f]{24,}"}
TOKEN = r"[A-Za-z0-9+/_-]{20,}"
ALPHABET = "0123456789abcdefABCDEFghijklmnopqrstuvwxyzGHIJKLMNOPQRSTUVWXYZ+/_-"
# narrowest class first: (name, pattern of the whole candidate, bits per character of a window)
CLASSES = (("hex", "^[0-9a-fA-F]+$", 2.9), ("alnum", "^[0-9a-zA-Z]+$", 3.6), ("token", "^[0-9a-zA-Z+/_-]+$", 3.7))
# A pattern that starts with ^ allows a stretch as a whole, with bits only while no window reaches them; the
# matches of any other pattern are cut out of the run.
ALLOW = (
    r"^[0-9_/+-]+$",  # numbers, dates, rules of dashes
    (r"^[A-Z]?[a-z]+$|^[A-Z]+$", 3.6),  # one word; 32 random letters have such a window in 95 of 100 cases
    # words joined into a path or a slug; no repeated group, whose matching would recurse per word
    r"^(?!.*[A-Za-z][A-Z])(?=[A-Za-z_/+-]*+$)[A-Za-z]*+[_/+-]",
    r"(?i)example|placeholder|xxxx",
)
CHUNK = 256


def _ends(lengths: Column) -> Column:
    """Running sums of an array of longs. Done in chunks, since appending to
    an array copies it: n * CHUNK / 2 steps instead of n * n / 2."""

    def running(part: Column, start: Column) -> Column:
        first = F.struct(start.cast("long").alias("sum"), F.array().cast("array<bigint>").alias("all"))
        return F.aggregate(
            part,
            first,
            lambda s, x: F.struct((s["sum"] + x).alias("sum"), F.concat(s["all"], F.array(s["sum"] + x)).alias("all")),
            lambda s: s["all"],
        )

    chunks = F.ceil(F.size(lengths) / F.lit(CHUNK)).cast("int")
    part = lambda c: F.slice(lengths, c * CHUNK + 1, CHUNK)
    totals = F.transform(F.sequence(F.lit(0), chunks - 1), lambda c: F.aggregate(part(c), F.lit(0).cast("long"), lambda a, x: a + x))
    before = F.concat(F.array(F.lit(0).cast("long")), running(totals, F.lit(0)))
    return F.flatten(F.transform(F.sequence(F.lit(0), chunks - 1), lambda c: running(part(c), F.get(before, c))))


def _matches(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def spans(text: Column, pattern: str, kind: str, group: int = 0, least: int = 0) -> Column:
    """Array of ``(start, end, kind, value)`` of the matches of a pattern, in
    code points. The matches and the pieces between them have the lengths
    that give the positions."""
    found = _matches(text, pattern)
    lengths = F.transform(
        F.arrays_zip(F.split(text, pattern, -1).alias("gap"), found.alias("hit")),
        lambda z: F.struct(F.length(z["gap"]).cast("long").alias("gap"), F.coalesce(F.length(z["hit"]), F.lit(0)).cast("long").alias("hit")),
    )
    ends = _ends(F.transform(lengths, lambda z: z["gap"] + z["hit"]))
    checked = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    none = F.array().cast("array<struct<start:bigint,end:bigint,kind:string,value:string>>")
    out = F.filter(
        F.transform(
            F.arrays_zip(found.alias("hit"), ends.alias("end"), checked.alias("part")),
            lambda z: F.struct(
                F.when(F.length(z["part"]) >= least, z["end"] - F.length(z["hit"])).alias("start"),
                z["end"].alias("end"),
                F.lit(kind).alias("kind"),
                z["hit"].alias("value"),
            ),
        ),
        lambda s: s["start"].isNotNull() & s["value"].isNotNull(),
    )
    return F.when(F.size(found) > 0, out.cast("array<struct<start:bigint,end:bigint,kind:string,value:string>>")).otherwise(none)


def hot_window(value: Column, bits: Column, window: int) -> Column:
    """First and last end (1-based index of a window's last character) of the
    windows whose entropy reaches ``bits``; both 0 without one.

    State: the count of each character in the window and the sum of
    ``c * log2 c``, from which the entropy is ``log2 w - sum / w``. A step
    changes the counts of the entering and the leaving character only.
    """
    clog = F.array(*[F.lit(c * math.log2(c) if c else 0.0) for c in range(window + 2)])
    zero = F.array_repeat(F.lit(0), len(ALPHABET))
    start = F.struct(zero.alias("n"), F.lit(0.0).alias("s"), F.lit(0).alias("first"), F.lit(0).alias("last"), bits.alias("bits"))

    def step(st: Column, z: Column) -> Column:
        add, out = z["in"], z["out"]
        cin, cout = F.get(st["n"], add), F.get(st["n"], out)
        plus = F.get(clog, cin + 1) - F.get(clog, cin)
        s = F.when(out == add, st["s"]).otherwise(
            st["s"] + plus + F.when(out < 0, F.lit(0.0)).otherwise(F.get(clog, cout - 1) - F.get(clog, cout))
        )
        counts = F.transform(st["n"], lambda c, j: c + F.when(j == add, 1).otherwise(0) - F.when(j == out, 1).otherwise(0))
        hot = (z["i"] >= window) & (F.lit(math.log2(window)) - s / F.lit(float(window)) >= st["bits"] - 1e-9)
        return F.struct(
            counts.alias("n"),
            s.alias("s"),
            F.when(hot & (st["first"] == 0), z["i"]).otherwise(st["first"]).alias("first"),
            F.when(hot, z["i"]).otherwise(st["last"]).alias("last"),
            st["bits"].alias("bits"),
        )

    # the character codes are made once per candidate, so a step costs the same however long the candidate is
    codes = F.transform(F.split(value, ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1)
    before = F.concat(F.array_repeat(F.lit(-1), window), codes)
    steps = F.transform(
        F.arrays_zip(codes.alias("in"), F.slice(before, 1, F.length(value)).alias("out")),
        lambda z, i: F.struct((i + 1).alias("i"), z["in"].alias("in"), z["out"].alias("out")),
    )
    return F.aggregate(steps, start, step, lambda st: F.struct(st["first"].alias("first"), st["last"].alias("last")))


def _without(z: Column, holes: Column, window: int) -> Column:
    """The parts ``(start, value)`` of a span that no hole touches, of at least
    ``window`` characters."""
    inside = F.filter(holes, lambda h: (h["start"] < z["end"]) & (z["start"] < h["end"]))

    def part(a: Column, near: Column) -> Column:
        after = F.array_min(F.transform(F.filter(near, lambda h: h["start"] >= a), lambda h: h["start"]))
        return F.struct(a.alias("start"), F.least(z["end"], F.coalesce(after, z["end"])).alias("end"))

    def parts(near: Column) -> Column:
        begins = F.array_distinct(F.concat(F.array(z["start"]), F.transform(near, lambda h: h["end"])))
        free = F.filter(begins, lambda a: ~F.exists(near, lambda h: (h["start"] <= a) & (a < h["end"])))
        return F.filter(F.transform(free, lambda a: part(a, near)), lambda p: p["end"] - p["start"] >= window)

    return F.transform(_let(inside, parts), lambda p: _piece(z, p["start"] - z["start"], p["end"] - z["start"]))


def _without_words(z: Column, pattern: str, window: int) -> Column:
    """The parts ``(start, value)`` of a span between the matches of a pattern."""

    def parts(hits: Column) -> Column:
        zero = F.array(F.lit(0).cast("long"))
        begins, ends = F.concat(zero, F.transform(hits, lambda h: h["end"])), F.transform(hits, lambda h: h["start"])
        pairs = F.arrays_zip(begins.alias("a"), F.concat(ends, F.array(F.length(z["value"]).cast("long"))).alias("b"))
        return F.transform(F.filter(pairs, lambda p: p["b"] - p["a"] >= window), lambda p: _piece(z, p["a"], p["b"]))

    whole = F.array(F.struct(z["start"].alias("start"), z["value"].alias("value")))
    return F.when(z["value"].rlike(pattern), _let(spans(z["value"], pattern, "word"), parts)).otherwise(whole)


def _piece(z: Column, a: Column, b: Column) -> Column:
    value = z["value"].substr((a + 1).cast("int"), (b - a).cast("int"))
    return F.struct((z["start"] + a).alias("start"), value.alias("value"))


def entropy_spans(text: Column, window: int, allow: Sequence[str | tuple[str, float]], classes=CLASSES, holes: Column | None = None) -> Column:
    """Spans ``(start, end, kind, value)`` of the high-entropy parts of token
    runs, one per run; kind is ``entropy-<class>``, the narrowest class that
    holds the whole span. ``holes``: spans that are cut out of the runs."""
    candidates = spans(text, TOKEN, "token")
    rules = [r if isinstance(r, tuple) else (r, None) for r in allow]
    words = "|".join(f"(?:{p})" for p, _ in rules if not p.startswith("^"))
    whole = [p for p, bound in rules if p.startswith("^") and bound is None]
    bounded = [(p, bound) for p, bound in rules if p.startswith("^") and bound is not None]

    runs = candidates
    if holes is not None:
        runs = F.flatten(F.transform(runs, lambda z: _without(z, holes, window)))
    if words:
        runs = F.flatten(F.transform(runs, lambda z: _without_words(z, words, window)))

    def needed(v: Column, bits: float) -> Column:
        out = F.lit(bits)
        for p, bound in bounded:
            out = F.when(v.rlike(p), F.greatest(out, F.lit(bound))).otherwise(out)
        return out

    def name(v: Column) -> Column:
        out = F.lit("none")
        for label, pattern, _ in reversed(classes):
            out = F.when(v.rlike(pattern), F.lit("entropy-" + label)).otherwise(out)
        return out

    def stretches(v: Column) -> Column:
        """``(start, value, bits)`` of the maximal stretches of each class that
        are not on the allow-list; a stretch counts for its narrowest class."""
        patterns = [pattern for _, pattern, _ in classes]

        def own(k: int) -> Column:
            found = spans(v, patterns[k].strip("^$").removesuffix("+") + f"{{{window},}}", "stretch")
            judged = F.filter(found, lambda z: ~_any(z["value"], [*whole, *patterns[:k]]))
            return F.transform(judged, lambda z: F.struct(z["start"].alias("start"), z["value"].alias("value"), needed(z["value"], classes[k][2]).alias("bits")))

        return F.concat(*[own(k) for k in range(len(classes))])

    def judge(z: Column) -> Column:
        hot = F.transform(
            stretches(z["value"]),
            lambda p: _let(
                hot_window(p["value"], p["bits"], window),
                lambda h: F.when(h["first"] > 0, F.struct((p["start"] + h["first"] - window).alias("first"), (p["start"] + h["last"]).alias("last"))),
            ),
        )
        both = lambda h: F.struct(F.array_min(h["first"]).alias("first"), F.array_max(h["last"]).alias("last"))
        return F.struct(z["start"].alias("start"), z["value"].alias("value"), _let(F.filter(hot, lambda h: h.isNotNull()), both).alias("h"))

    judged = F.transform(runs, judge)
    out = F.transform(
        F.filter(judged, lambda z: z["h"]["first"].isNotNull()),
        lambda z: F.struct(
            (z["start"] + z["h"]["first"]).alias("start"),
            (z["start"] + z["h"]["last"]).alias("end"),
            name(z["value"].substr((z["h"]["first"] + 1).cast("int"), (z["h"]["last"] - z["h"]["first"]).cast("int"))).alias("kind"),
            z["value"].alias("value"),
        ),
    )
    return F.when(F.size(candidates) > 0, out).otherwise(F.array().cast("array<struct<start:bigint,end:bigint,kind:string,value:string>>"))


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _any(v: Column, patterns: Sequence[str]) -> Column:
    out = F.lit(False)
    for p in patterns:
        out = out | v.rlike(p)
    return out


def scan_secrets(
    df: DataFrame,
    text_col: str = "text",
    id_col: str = "doc_id",
    kinds: Mapping[str, tuple[str, int, int]] | None = None,
    window: int = 20,
    allow: Sequence[str | tuple[str, float]] = ALLOW,
    classes=CLASSES,
) -> DataFrame:
    """One row per input row: ``<id_col>, base, added``: arrays of
    ``(start, end, kind, value)`` in code points, end exclusive.

    ``base``: the leftmost non-overlapping matches of each kind whose group is
    long enough, in the order of start, then of kind. ``added``: entropy spans
    of what the base spans leave of each run. Null and empty texts have no spans; ids may be
    null or repeat; other columns of the input are ignored.
    """
    kinds = dict(kinds or BASE_KINDS)
    text = F.col("_text")
    base = df.select(F.col(id_col), text_or_empty(text_col).alias("_text"))
    for k, (kind, (pattern, group, least)) in enumerate(kinds.items()):
        run = RUN_PATTERNS.get(kind) if kinds[kind] == BASE_KINDS.get(kind) else None
        base = base.withColumn(f"_k{k}", spans(text, run or pattern, kind, group, 0 if run else least))
    names = F.array(*[F.lit(k) for k in kinds])
    everything = F.concat(*[F.col(f"_k{k}") for k in range(len(kinds))])
    order = lambda s: F.struct(s["start"].alias("start"), F.array_position(names, s["kind"]).alias("k"), s["end"].alias("end"), s["kind"].alias("kind"), s["value"].alias("value"))
    plain = lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"), s["value"].alias("value"))
    base = base.withColumn("base", F.transform(F.array_sort(F.transform(everything, order)), plain))
    return base.select(id_col, "base", entropy_spans(text, window, allow, classes, F.col("base")).alias("added"))


def span_list(col: str | Column) -> Column:
    """``kind:start:end`` of an array of spans, comma-joined."""
    return F.array_join(F.transform(col, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
