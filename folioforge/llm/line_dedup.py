"""Line deduplication within an edit distance: a segment-partition join in DataFrame functions alone.

A line is cut into threshold + 1 segments. Of two lines within the threshold, the shorter has a segment that the
longer holds at nearly the same place, so an index of segments probed with the few substrings that could match
(multi-match-aware, by length) meets every such pair. Only hashes of segments of distinct lines are shuffled.

Two rules share that join. By characters: at most `threshold` edits, lines of any length; a signature of letter
counts in the join refuses most pairs that share a segment but are too far apart. By words (`percent`): edits are
of whole words, and as many are allowed as percent of the shorter line's words, rounded. Lengths of like
thresholds form a class then, with segments of one size at fixed places, and a longer line is probed at the places where a
segment may have moved to.

A segment of more than MANY lines is not joined line by line. Its lines first meet the earliest line of each of
PIVOTS parts, which settles those that have a near line among them; only what is left meets the others, in blocks.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.llm.shared import SPACE_RUN, SPACES, checked, dropped, written

#: Edit distance in characters.
THRESHOLD = 2
#: Bytes of a word in a line's code.
WORD = 4
#: Lines of a segment that are joined one by one at most; parts with a pivot each; lines of a block beyond.
MANY, PIVOTS, BLOCK = 32, 8, 2048
#: Word edits from which on a class is probed at every place: the places where segments may lie then cover the line.
EVERYWHERE = 24
#: Characters after the first difference that are compared before the rest.
HEAD = 12
#: Pairs of lines that a task verifies.
PAIRS = 20_000
#: Letters counted in the signature, five bits each in a long (twelve at most).
LETTERS = "entairsh"


def character_code(line: Column) -> Column:
    """A byte for each character, so that cutting needs no walk; beyond Latin-1 all are `?`. Equal lines have equal codes."""
    latin = F.encode(F.regexp_replace(line, r"[^\x00-\xFF]", "?"), "ISO-8859-1")
    return F.when(F.octet_length(line) == F.length(line), line.cast("binary")).otherwise(latin)


def words(line: Column) -> Column:
    """The line's words; none of a line of spaces alone."""
    trimmed = F.btrim(line, F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_RUN))


def word_code(line: Column) -> Column:
    """WORD bytes of a hash for each word."""
    return F.unhex(F.array_join(F.transform(words(line), lambda w: F.lpad(F.hex(F.xxhash64(w).bitwiseAND(F.lit(0xFFFF7FFF))), 2 * WORD, "0")), ""))


def segment(length: Column, i: Column, threshold: int) -> tuple[Column, Column]:
    """(first place from 1, length) of segment i of a line of that length: short ones first, one longer after."""
    parts = threshold + 1
    base = F.floor(length / parts).cast("int")
    short = parts - (length - base * parts)
    return i * base + F.greatest(F.lit(0), i - short) + 1, base + (i >= short).cast("int")


def moves(threshold: int) -> list[tuple[int, int, int]]:
    """(shorter, i, shift): where segment i of a line shorter by that much may lie in the longer one."""
    out = []
    for shorter in range(threshold + 1):
        for i in range(threshold + 1):
            # i edits at most lie before the segment, threshold - i behind it.
            low, high = max(-i, shorter - (threshold - i)), min(i, shorter + (threshold - i))
            out += [(shorter, i, shift) for shift in range(low, high + 1)]
    return out


def _cuts(lines: DataFrame, of: list[tuple[int, int, int]], threshold: int) -> DataFrame:
    """lines (code, ...) with k, a key of the substring, and shorter, for each of the moves that the line has room for.

    The moves are exploded, not their keys: an array of all keys is one expression too large for the JVM to compile.
    """
    move = F.array(*[F.struct(*[F.lit(v).alias(name) for v, name in zip(m, ("shorter", "i", "shift"))]) for m in of])
    n, i = F.octet_length("code") - F.col("move.shorter"), F.col("move.i")
    start, size = segment(n, i, threshold)
    key = F.xxhash64(n, i, F.substring(F.col("code"), start + F.col("move.shift"), size))
    return lines.select("*", F.explode(move).alias("move")).where(n >= 0).select(*[c for c in lines.columns if c != "code"], key.alias("k"), F.col("move.shorter").alias("shorter"))


def index_rows(lines: DataFrame, threshold: int) -> DataFrame:
    """Keys of the lines' segments."""
    return _cuts(lines, [(0, i, 0) for i in range(threshold + 1)], threshold).drop("shorter")


def probe_rows(lines: DataFrame, threshold: int) -> DataFrame:
    """Keys of the substrings that may equal a segment of a line shorter by 0..threshold, with that difference."""
    return _cuts(lines, moves(threshold), threshold)


def allowance(length: Column, percent: int) -> Column:
    """Words that may differ when the shorter line has that many: percent of them, rounded."""
    return F.floor((2 * percent * length + 100) / 200).cast("int")


def _class(t: Column) -> tuple[Column, Column]:
    """(first, last) number of edits of the class with t: those with the same four leading bits."""
    wide = F.call_function("shiftleft", F.lit(1), F.greatest(F.lit(0), F.length(F.bin(t)) - 4))
    first = (t - t % wide).cast("int")
    return first, (first + wide - 1).cast("int")


def _least(t: Column, percent: int) -> Column:
    """The least length to which t edits are allowed."""
    return F.ceil((200 * t - 100) / (2 * percent)).cast("int")


def _cut(code: Column, places: Column, size: Column, t: Column) -> Column:
    """Key of the run of that many words at each place from 0."""
    return F.transform(places, lambda q: F.xxhash64(t, F.substring(code, q * WORD + 1, size * WORD)))


def class_index(code: Column, percent: int) -> Column:
    """Keys of the line's segments, one more than the class's last number of edits."""

    def keys(x: Column) -> Column:
        size = F.floor(_least(x["first"], percent) / (x["last"] + 1)).cast("int")
        return bound({"last": x["last"], "size": size}, lambda y: _cut(code, F.transform(F.sequence(F.lit(0), y["last"]), lambda i: i * y["size"]), y["size"], y["last"]))

    first, last = _class(allowance(F.octet_length(code) / WORD, percent))
    return bound({"first": first, "last": last}, keys)


def class_probes(code: Column, percent: int) -> Column:
    """Keys of the runs of words that may equal a segment of a line no longer than this."""
    none = F.array().cast("array<int>")

    def one(n: Column, first: Column, last: Column) -> Column:
        # Lines of the class are shorter by few..many.
        few, many = F.greatest(F.lit(0), n - _least(last + 1, percent) + 1), F.least(last, n - _least(first, percent))
        size = F.floor(_least(first, percent) / (last + 1)).cast("int")

        def keys(x: Column) -> Column:
            # i edits at most lie before the segment, last - i behind it.
            def moved(i: Column) -> Column:
                low, high = F.greatest(-i, x["few"] - x["t"] + i), F.least(i, x["many"] + x["t"] - i)
                a, b = F.greatest(F.lit(0), i * x["size"] + low), F.least(x["n"] - x["size"], i * x["size"] + high)
                return F.when(a <= b, F.sequence(a, F.greatest(a, b))).otherwise(none)

            some = F.array_distinct(F.flatten(F.transform(F.sequence(F.lit(0), x["t"]), moved)))
            places = F.when(x["few"] > x["many"], none).when(x["t"] < EVERYWHERE, some).otherwise(F.sequence(F.lit(0), x["n"] - x["size"]))
            return _cut(code, places, x["size"], x["t"])

        return bound({"n": n, "t": last, "few": few, "many": many, "size": size}, keys)

    def every(x: Column) -> Column:
        # The shortest partner has n - most words at least.
        low = F.greatest(F.lit(1), allowance(x["n"] - x["most"], percent))
        classes = F.array_distinct(F.transform(F.sequence(low, F.greatest(low, x["most"])), lambda t: F.struct(*[c.alias(k) for c, k in zip(_class(t), ("first", "last"))])))
        return F.when(low <= x["most"], F.flatten(F.transform(classes, lambda c: one(x["n"], c["first"], c["last"]))))

    n = (F.octet_length(code) / WORD).cast("int")
    return bound({"n": n, "most": allowance(n, percent)}, every)


def bound(values: dict[str, Column], use) -> Column:
    """use(struct of the values), where each value is computed once however often it is used."""
    return F.get(F.transform(F.array(F.struct(*[v.alias(k) for k, v in values.items()])), use), 0)


def signature(line: Column, letters: str = LETTERS) -> Column:
    """A long with the counts of up to twelve letters, modulo 32, in Gray code: one more or less changes one bit."""
    out = F.lit(0).cast("long")
    for i, c in enumerate(letters):
        n = (F.octet_length(line) - F.octet_length(F.replace(line, F.lit(c), F.lit("")))) % 32  # letters are one byte
        out = out.bitwiseOR(F.shiftleft(n.bitwiseXOR(F.shiftright(n, 1)).cast("long"), 5 * i))
    return out


def flips(a: Column, b: Column) -> Column:
    """At most twice the edit distance of what has these signatures: bits that differ."""
    return F.bit_count(a.bitwiseXOR(b))


def trimmed(a: Column, b: Column) -> Column:
    """struct a, b without their common beginning and end, which no shortest edit needs to touch."""
    steps = F.array(*[F.lit(1 << i) for i in range(14, -1, -1)])
    longest = lambda same: F.aggregate(steps, F.lit(0), lambda n, s: F.when(same(n, s), n + s).otherwise(n))

    def front(x: Column) -> Column:
        n = longest(lambda n, s: (n + s <= F.least(F.length(x["a"]), F.length(x["b"]))) & (F.substr(x["a"], n + 1, s) == F.substr(x["b"], n + 1, s)))
        return bound({"n": n, "a": x["a"], "b": x["b"]}, lambda y: F.struct(F.substr(y["a"], y["n"] + 1).alias("a"), F.substr(y["b"], y["n"] + 1).alias("b")))

    def back(x: Column) -> Column:
        tail = lambda c, n, s: F.substr(c, F.length(c) - n - s + 1, s)
        n = longest(lambda n, s: (n + s <= F.least(F.length(x["a"]), F.length(x["b"]))) & (tail(x["a"], n, s) == tail(x["b"], n, s)))
        return bound({"n": n, "a": x["a"], "b": x["b"]}, lambda y: F.struct(F.substr(y["a"], F.lit(1), F.length(y["a"]) - y["n"]).alias("a"), F.substr(y["b"], F.lit(1), F.length(y["b"]) - y["n"]).alias("b")))

    return bound({"x": bound({"a": a, "b": b}, front)}, lambda x: back(x["x"]))


def automaton(pattern: Column, text: Column, threshold: int) -> Column:
    """Last register, after all of the text, of a banded bit-parallel automaton.

    Register e has bit k + threshold set when the first j + k characters of the pattern are within e edits of the
    first j of the text, for k in -threshold..threshold. For each character of the text, the band's matches are
    one word, and all diagonals advance at once: by match, substitution, insertion and deletion.
    """
    band = 2 * threshold + 1

    def matches(x: Column, j: Column) -> Column:
        bits = [F.shiftleft(F.coalesce(F.get(x["p"], j + k) == F.get(x["t"], j), F.lit(False)).cast("int"), k + threshold) for k in range(-threshold, threshold + 1)]
        return sum(bits[1:], bits[0])

    def advance(state: Column, m: Column) -> Column:
        new = []
        for e in range(threshold + 1):
            r = state[f"r{e}"].bitwiseAND(m)
            if e:
                before = state[f"r{e - 1}"]
                r = r.bitwiseOR(before).bitwiseOR(F.shiftright(before, 1)).bitwiseOR(F.shiftleft(new[-1], 1)).bitwiseAND(F.lit((1 << band) - 1))
            new.append(r)
        return F.struct(*[r.alias(f"r{e}") for e, r in enumerate(new)])

    # Before any character of the text, k characters of the pattern are k deletions away.
    start = F.struct(*[F.lit(((1 << (e + 1)) - 1) << threshold).alias(f"r{e}") for e in range(threshold + 1)])
    places = F.when(F.length(text) > 0, F.sequence(F.lit(0), F.length(text) - 1)).otherwise(F.array().cast("array<int>"))
    words = bound({"p": F.split(pattern, ""), "t": F.split(text, ""), "js": places}, lambda x: F.transform(x["js"], lambda j: matches(x, j)))
    return F.aggregate(words, start, advance, lambda s: s[f"r{threshold}"])


def within(a: Column, b: Column, threshold: int) -> Column:
    """Whether the edit distance is at most threshold.

    Only what lies between the first and the last difference is compared, and most pairs end after its first
    HEAD characters, where the automaton has no state left.
    """

    def decide(x: Column) -> Column:
        p, t = x["a"], x["b"]
        alive = automaton(F.substr(p, F.lit(1), F.lit(HEAD + threshold)), F.substr(t, F.lit(1), F.lit(HEAD)), threshold) != 0
        bit = F.call_function("shiftright", automaton(p, t, threshold), F.length(p) - F.length(t) + threshold).bitwiseAND(F.lit(1))
        return F.when(F.abs(F.length(p) - F.length(t)) > threshold, False).when(~alive, False).otherwise(bit == 1)

    return bound({"x": trimmed(a, b)}, lambda x: decide(x["x"]))


def word_letters(code: Column) -> Column:
    """A character for each word (15 bits of its hash): edits between these are never more than between the words."""
    return F.decode(F.unhex(F.regexp_replace(F.hex(code), ".{4}(.{4})", "$1")), "UTF-16BE")


def parities(numbers: Column) -> Column:
    """A long whose bit i tells whether an odd number of the numbers end in the six bits i: an edit flips two at most."""
    return F.aggregate(numbers, F.lit(0).cast("long"), lambda bits, x: bits.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), (x % 64).cast("int"))))


def word_numbers(code: Column, first: int) -> Column:
    """A byte of each word's hash, as numbers."""
    n = (F.octet_length(code) / WORD).cast("int")
    byte = lambda i: F.conv(F.hex(F.substring(code, i * WORD + 1 + first, 1)), 16, 10).cast("int")
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1), byte)).otherwise(F.array().cast("array<int>"))


def _run(code: Column, first: Column, n: Column) -> Column:
    """That many words of a code, from a place from 0."""
    return F.substring(code, first * WORD + 1, n * WORD)


def trimmed_words(a: Column, b: Column) -> Column:
    """struct a, b: codes without the words that they begin and end with alike."""
    steps = F.array(*[F.lit(1 << i) for i in range(20, -1, -1)])
    longest = lambda same: F.aggregate(steps, F.lit(0), lambda n, s: F.when(same(n, s), n + s).otherwise(n))
    size = lambda c: (F.octet_length(c) / WORD).cast("int")

    def front(x: Column) -> Column:
        n = longest(lambda n, s: (n + s <= F.least(size(x["a"]), size(x["b"]))) & (_run(x["a"], n, s) == _run(x["b"], n, s)))
        return bound({"n": n, "a": x["a"], "b": x["b"]}, lambda y: F.struct(*[_run(y[c], y["n"], size(y[c]) - y["n"]).alias(c) for c in "ab"]))

    def back(x: Column) -> Column:
        tail = lambda c, n, s: _run(c, size(c) - n - s, s)
        n = longest(lambda n, s: (n + s <= F.least(size(x["a"]), size(x["b"]))) & (tail(x["a"], n, s) == tail(x["b"], n, s)))
        return bound({"n": n, "a": x["a"], "b": x["b"]}, lambda y: F.struct(*[_run(y[c], F.lit(0), size(y[c]) - y["n"]).alias(c) for c in "ab"]))

    return bound({"x": bound({"a": a, "b": b}, front)}, lambda x: back(x["x"]))


def within_words(a: Column, b: Column, percent: int) -> Column:
    """Whether lines with these codes differ in as many words as percent allows at most.

    Only what lies between the first and the last difference is compared. Its words are numbered within the pair and
    each number spelt as one character, so that equal words alone are equal.
    """
    none = F.array().cast("array<binary>")

    def own(c: Column) -> Column:
        n = (F.octet_length(c) / WORD).cast("int")
        return F.when(n > 0, F.transform(F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1), lambda i: _run(c, i, F.lit(1)))).otherwise(none)

    def spelt(x: Column, c: str) -> Column:
        number = lambda i: F.lpad(F.hex(F.when(i < 0xD700, i).otherwise(i + 0x900)), 8, "0")  # noqa: E731  past the surrogates
        return F.decode(F.unhex(F.array_join(F.transform(x[c], lambda w: number(F.array_position(x["all"], w))), "")), "UTF-32")

    def decide(x: Column) -> Column:
        # Beyond a million different words a pair would run out of characters; such parts are far apart.
        far = (F.abs(F.size(x["a"]) - F.size(x["b"])) > x["tau"]) | (F.size(x["all"]) > 1_000_000)
        return F.when(far, False).otherwise(F.call_function("levenshtein", spelt(x, "a"), spelt(x, "b"), x["tau"]) >= 0)

    def compare(x: Column) -> Column:
        return bound({"tau": x["tau"], "a": own(x["x"]["a"]), "b": own(x["x"]["b"])}, lambda y: bound({"tau": y["tau"], "a": y["a"], "b": y["b"], "all": F.array_distinct(F.concat(y["a"], y["b"]))}, decide))

    tau = allowance(F.least(F.octet_length(a), F.octet_length(b)) / WORD, percent)
    return bound({"tau": tau, "x": trimmed_words(a, b)}, compare)


def _lines(docs: DataFrame, id_col: str, text_col: str, gone: DataFrame | None = None) -> DataFrame:
    """(d, t, p, line) of every line with something in it: document id, hash of its text, place from 0.

    gone (d, t, places) names lines to leave out; it is joined before lines are made, so text moves only if gone
    has too many rows to broadcast.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("d"), F.xxhash64(text).alias("t"), text.alias("text"))
    if gone is None:
        rows = rows.select("d", "t", F.posexplode(F.split("text", "\n", -1)).alias("p", "line"))
        return rows.where(F.btrim("line") != "")
    gone = checked(gone)
    both = rows.join(gone, rows["d"].eqNullSafe(gone["d"]) & (rows["t"] == gone["t"]), "left")
    rows = both.select(rows["d"], rows["t"], "places", F.posexplode(F.split("text", "\n", -1)).alias("p", "line"))
    return rows.where((F.btrim("line") != "") & ~F.coalesce(F.array_contains("places", F.col("p")), F.lit(False))).drop("places")


def _order(d: Column) -> Column:
    return F.struct(d.isNull().alias("z"), d.alias("d"), F.col("t").alias("t"), F.col("p").alias("p"))


def _named() -> list[Column]:
    return [F.xxhash64("line").alias("h"), F.xxhash64(F.lit(1), F.col("line")).alias("g")]


@lru_cache
def _near(threshold: int, percent: int) -> Column:
    """Whether a and b are near. The compiled distance only spares far pairs the rest. (Long expressions are built once.)"""
    a, b = F.col("a"), F.col("b")
    if not percent:
        return F.when(F.call_function("levenshtein", a, b, F.lit(threshold)) < 0, False).otherwise(within(a, b, threshold))
    tau = allowance(F.least(F.octet_length(a), F.octet_length(b)) / WORD, percent)
    return F.when(F.call_function("levenshtein", F.col("la"), F.col("lb"), tau) < 0, False).otherwise(within_words(a, b, percent))


@lru_cache
def _alike(threshold: int, one: str, two: str) -> Column:
    """Whether signatures allow the threshold of character edits."""
    return flips(F.col(one), F.col(two)) <= 2 * threshold


def _more(percent: int) -> Column:
    """Parities of lines that meet others in pairs."""
    return parities(word_numbers(F.col("code"), WORD - 2) if percent else F.transform(F.split("line", ""), lambda c: F.ascii(c))).alias("s0")


@lru_cache
def _alike_pairs(threshold: int, percent: int) -> Column:
    """Whether lines x and y may be near by their lengths in bytes (n) and their signatures."""
    odd = flips(F.col("x.s0"), F.col("y.s0"))
    if not percent:
        return (odd <= 2 * threshold) & _alike(threshold, "x.s", "y.s")
    tau = allowance(F.least("x.n", "y.n") / WORD, percent)
    return (F.abs(F.col("x.n") - F.col("y.n")) <= WORD * tau) & (odd <= 2 * tau) & (flips(F.col("x.s"), F.col("y.s")) <= 2 * tau)


def _verified(pairs: DataFrame, fresh: DataFrame, threshold: int, percent: int) -> DataFrame:
    """(h) of the lines that are near the earlier one of a pair (h, h2)."""
    pairs = written(pairs.select(F.least("h", "h2").alias("h"), F.greatest("h", "h2").alias("h2")).distinct(), "line-pairs")
    n = pairs.count()
    if not n:
        return pairs.select("h")
    names = written(pairs.select("h").union(pairs.select("h2")).distinct(), "line-names")
    texts = held = written(fresh.join(checked(names), "h", "left_semi"), "line-texts")
    if percent:  # counts refuse most pairs before their codes move
        names_of = texts.select("h", "s", _more(percent), F.octet_length("code").alias("n"))
        some = pairs.join(names_of.alias("x"), "h").join(names_of.withColumnRenamed("h", "h2").alias("y"), "h2")
        some = written(some.where(_alike_pairs(threshold, percent)).select("h", "h2"), "line-pairs")
        dropped(pairs)
        pairs, n = some, some.count()
        texts = texts.withColumn("letters", word_letters(F.col("code")))
    one = texts.select("h", F.col("f").alias("fa"), *([F.col("code").alias("a"), F.col("letters").alias("la")] if percent else [F.col("line").alias("a")]))
    two = texts.select(F.col("h").alias("h2"), F.col("f").alias("fb"), *([F.col("code").alias("b"), F.col("letters").alias("lb")] if percent else [F.col("line").alias("b")]))
    both = pairs.join(one, "h").join(two, "h2")
    # Few bytes, much work for each: spread by number, which isn't coalesced.
    tasks = max(docs_parallelism(fresh), -(-n // PAIRS))
    both = both.repartition(tasks)
    close = both.where(_near(threshold, percent))
    late = close.select(F.when(F.col("fa") < F.col("fb"), F.col("h2")).otherwise(F.col("h")).alias("h")).distinct()
    late = written(late, "line-late")
    dropped(pairs, names, held)
    return late


def docs_parallelism(df: DataFrame) -> int:
    return 4 * df.sparkSession.sparkContext.defaultParallelism


def _blocks(rows: DataFrame, per: DataFrame) -> DataFrame:
    """rows (k, ...) with block, a part of about BLOCK lines of its segment; per: lines of each segment (k, c)."""
    own = rows.join(checked(per.select(F.col("k").alias("_k"), "c")), F.col("k") == F.col("_k"))
    return own.withColumn("block", F.pmod(F.xxhash64("h", F.lit(3)), F.ceil(F.col("c") / BLOCK)).cast("int")).drop("_k")


def _crowded(rows: DataFrame, fresh: DataFrame, late: DataFrame, threshold: int, percent: int) -> list[DataFrame]:
    """Late lines (h) among those of crowded segments (k, h), that late doesn't hold yet."""
    names = written(rows.select("h").distinct(), "crowd-names")
    places = fresh.join(checked(names), "h", "left_semi").select(F.col("h").alias("_h"), "f", "s", _more(percent), F.octet_length("code" if percent else "line").alias("n"))
    crowd = written(rows.join(places, F.col("h") == F.col("_h")).drop("_h"), "crowd")
    own = ["f", *(c for c in crowd.columns if c not in ("k", "f"))]
    near = _alike_pairs(threshold, percent)
    pivots = crowd.groupBy("k", F.pmod(F.xxhash64("h", F.lit(2)), F.lit(PIVOTS)).alias("part")).agg(F.min(F.struct(*own)).alias("y"))
    pivots = written(pivots.select("k", "y.*"), "line-pivots")
    # Parts go by the line's hash, so a line's segments have much the same pivots.
    left = crowd.join(checked(late), "h", "left_anti")
    met = left.alias("x").join(checked(pivots).alias("y"), F.expr("x.k = y.k and y.f < x.f")).where(near)
    found = [_verified(met.select(F.col("x.h").alias("h"), F.col("y.h").alias("h2")), fresh, threshold, percent)]
    left = written(left.join(checked(found[0]), "h", "left_anti"), "crowd-left")
    if left.limit(1).count():
        # What has no near pivot: blocks of it against blocks of all its segment's lines, so no task holds a whole segment.
        per = written(crowd.groupBy("k").agg(F.count("*").alias("c")), "crowd-sizes")
        ask, all_of = _blocks(left, per).withColumnRenamed("block", "b1"), _blocks(crowd, per).withColumnRenamed("block", "b2")
        parts = F.sequence(F.lit(0), (F.ceil(F.col("c") / BLOCK) - 1).cast("int"))
        x, y = ask.withColumn("b2", F.explode(parts)).alias("x"), all_of.withColumn("b1", F.explode(parts)).alias("y")
        both = x.join(y, F.expr("x.k = y.k and x.b1 = y.b1 and x.b2 = y.b2 and y.f < x.f")).where(near)
        found.append(_verified(both.select(F.col("x.h").alias("h"), F.col("y.h").alias("h2")), fresh, threshold, percent))
        dropped(per)
    dropped(names, crowd, pivots, left)
    return found


def gone(docs: DataFrame, threshold: int = THRESHOLD, id_col: str = "doc_id", text_col: str = "text", percent: int = 0) -> DataFrame:
    """(d, t, places): per document (id and hash of text) the places of lines to remove.

    A line goes if one that comes before it is equal or near. Near is, without percent, within threshold edits of
    characters, whatever their length; with percent, within that share of the shorter line's words (rounded, so
    fewer than 10 words must be equal at 5 percent), spaces between words not counted. Lines are in order of document id (null last), hash of the
    text, place; all are judged on the input.
    """
    if not 0 <= percent <= 50:
        raise ValueError(f"percent must lie between 0 and 50, not {percent}")
    occurrences = written(_lines(docs, id_col, text_col).select("d", "t", "p", *_named()), "lines")
    first = occurrences.groupBy("h", "g").agg(F.min(_order(F.col("d"))).alias("first"))
    again = occurrences.join(first, ["h", "g"]).where(F.col("first") < _order(F.col("d")))
    again = written(again.groupBy("d", "t").agg(F.collect_set("p").alias("places")), "again")
    dropped(occurrences)

    # What is left has every line once, where it first stands.
    line = F.col("line")
    fresh = _lines(docs, id_col, text_col, again)
    if percent:
        fresh = fresh.select(F.xxhash64("line").alias("h"), word_code(line).alias("code"), _order(F.col("d")).alias("f")).withColumn("s", parities(word_numbers(F.col("code"), WORD - 1)))
    else:
        fresh = fresh.select(F.xxhash64("line").alias("h"), "line", signature(line).alias("s"), _order(F.col("d")).alias("f"))
    fresh = written(fresh, "fresh")
    code = F.col("code")
    if percent:
        some = fresh.where(allowance(F.octet_length("code") / WORD, percent) > 0)
        index = some.select("h", F.explode(class_index(code, percent)).alias("k"))
        probes = some.select(F.col("h").alias("h2"), F.explode(class_probes(code, percent)).alias("k2"))
        near = F.col("h") != F.col("h2")
    else:
        some = fresh.select("h", "s", character_code(line).alias("code"))
        index = index_rows(some, threshold)
        probes = probe_rows(some, threshold).select(F.col("h").alias("h2"), F.col("s").alias("s2"), F.col("k").alias("k2"), "shorter")
        # Of lines of one length, either may be the indexed one.
        near = (F.col("h") != F.col("h2")) & ((F.col("shorter") > 0) | (F.col("h") < F.col("h2"))) & _alike(threshold, "s", "s2")
    crowded = written(index.groupBy("k").agg(F.count("*").alias("c")).where(F.col("c") > MANY).select("k"), "crowded")
    some_crowded = crowded.limit(1).count() > 0
    if some_crowded:  # such a segment meets its probes once, with no line named
        rare = index.join(checked(crowded), "k", "left_anti")
        index = rare.unionByName(crowded.select("k"), allowMissingColumns=True)
        near = F.col("h").isNull() | near
    met = written(index.join(probes, (F.col("k") == F.col("k2")) & near).select("h", "h2", F.when(F.col("h").isNull(), F.col("k")).alias("k")), "line-met")
    late = [_verified(met.where("h is not null").select("h", "h2"), fresh, threshold, percent)]
    if some_crowded:
        rows = some.select("h", F.explode(class_index(code, percent)).alias("k")) if percent else index_rows(some.drop("s"), threshold)
        rows = rows.join(checked(crowded), "k", "left_semi").unionByName(met.where("h is null").select(F.col("h2").alias("h"), "k"))
        rows = written(rows.distinct(), "crowd-rows")
        late += _crowded(rows, fresh, late[0], threshold, percent)
        dropped(rows)
    names = late[0]
    for x in late[1:]:
        names = names.union(x)
    lines = fresh.join(checked(names.distinct()), "h", "left_semi").select("f.d", "f.t", "f.p")

    every_place = again.select("d", "t", F.explode("places").alias("p")).unionByName(lines)
    out = written(every_place.groupBy("d", "t").agg(F.collect_set("p").alias("places")), "line-places")
    dropped(again, fresh, crowded, met)
    return out


def _marked(docs: DataFrame, threshold: int, id_col: str, text_col: str, percent: int) -> tuple[DataFrame, Column, Column, Column]:
    """(docs with the places joined, all lines, kept lines, number of removed ones)."""
    own = checked(gone(docs, threshold, id_col, text_col, percent))
    text, places = F.coalesce(docs[text_col], F.lit("")), own["places"]
    rows = docs.join(own, docs[id_col].eqNullSafe(own["d"]) & (F.xxhash64(text) == own["t"]), "left")
    lines = F.split(text, "\n", -1)
    kept = F.when(places.isNull(), lines).otherwise(F.filter(lines, lambda x, i: ~F.array_contains(places, i)))
    return rows, lines, kept, F.coalesce(F.size(places), F.lit(0)).cast("long")


def line_dedup(docs: DataFrame, threshold: int = THRESHOLD, id_col: str = "doc_id", text_col: str = "text", percent: int = 0) -> DataFrame:
    """One row per input row: doc_id, n_lines, n_removed, kept_sha256 (of the kept lines joined by line feeds).

    Lines are what line feeds separate; blank ones stay and are never compared. Null texts count as empty (one
    blank line). Rows that repeat id and text are one document and keep the same lines; null ids come last.
    Other columns are ignored; an empty input gives an empty result. See gone() for what goes.
    """
    rows, lines, kept, n = _marked(docs, threshold, id_col, text_col, percent)
    return rows.select(
        docs[id_col].alias("doc_id"), F.size(lines).cast("long").alias("n_lines"), n.alias("n_removed"),
        F.sha2(F.array_join(kept, "\n").cast("binary"), 256).alias("kept_sha256"),
    )


def without_lines(docs: DataFrame, threshold: int = THRESHOLD, id_col: str = "doc_id", text_col: str = "text", percent: int = 0) -> DataFrame:
    """The input's rows and columns with the kept lines as text; null texts stay null."""
    rows, _, kept, _ = _marked(docs, threshold, id_col, text_col, percent)
    new = F.when(docs[text_col].isNotNull(), F.array_join(kept, "\n"))
    return rows.select(*[new.alias(c) if c == text_col else docs[c] for c in docs.columns])
