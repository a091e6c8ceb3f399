"""Fuzzy line deduplication in SQL functions only.

A line is normalised: lower case, every run of digits as 0, every run of ASCII
characters that are neither letters nor digits as one space. Lines with equal
normal forms are one class. Two classes are linked if they share a key and the
edit distance of their normal forms is at most 1 - `similarity` of the longer
one's length. Of every connected group of lines one occurrence stays, the first
by doc_id (nulls last) and line.

Keys by the pigeonhole principle: a line is cut into parts, two counted from its
left end, two from its right end and what lies between. An exchanged character
spoils one part; an inserted or missing one spoils its own and those between it
and the middle, which is counted from both ends. Each part has a 64-bit SimHash
over its three thirds (a bit is set if it is in two of their hashes), and
unspoiled parts have equal ones. A key holds the SimHashes of some parts, so few
enough edits leave a key that both lines have:

* lines of up to 25 bytes: either half, by the longer line's length, so any one
  edit leaves a key, and from 18 on any three of five parts;
* up to 86 bytes: any pair of the left two parts or of the other three, so any two
  spoiled parts leave a key;
* longer ones: any part, so any four spoiled parts leave a key.

Part lengths follow from steps of a factor 1.5 in the line's length, and a line
near the end of a step has the keys of the next one too. Words play no role, so
scripts without spaces are treated alike. A line with an edit in every part has
no key in common with its original; README gives the recall by edits and length.

The classes of a bucket (a key) are compared with its first class and, where
that has not put them in one group already, with its last class.
Where a bucket then still holds several connected groups, the classes outside
its largest group are compared with a few of that group, twice; what is apart
after that is compared with all other groups' classes there, if the lengths
allow it. So the groups equal those of all pairs of a bucket, and no bucket of
near lines sends out all its pairs. Before an edit distance is taken, common
ends are cut off by bisection, so its cost follows from what lies between the
first and the last edit.

Defined cases: a line without letters, digits or non-ASCII characters is never
removed; a null text stays null; an empty text is one empty line; lines under 9
characters are only ever equal; lines and texts of any length are whole; of
equal lines the first stays; of repeated rows the later ones lose the lines that
the first keeps; a null doc_id comes after all others; an empty table gives no
rows; columns with other names, also those used here, are kept as they are.
"""

from __future__ import annotations

import itertools
import math
import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .components import components
from .staging import keep

SIMILARITY = 0.9
#: Step between line lengths that are cut alike.
STEP = 1.5
#: Steps from which pairs of parts, and single parts, are keys: lengths of 25.6 and 86.5.
PAIRS, SINGLES = 8, 11
#: Looks at what the pivots of a bucket have left apart, before all of it is compared.
LOOKS = 2
#: Characters of the classes outside a bucket's largest group that are compared with all others of a length in one part, about.
STRAYS = 16384
#: Bytes that an edit can change a line's length by.
_WIDEST = 3
#: Share of a step's least length that each part at an end has.
SHARE = 0.2


def _listed(codes) -> str:
    """A character class with each character on its own, which Java looks up in a table; ranges are tried one by one."""
    return "[" + "".join(f"\\x{c:02X}" for c in codes) + "]"


#: ASCII characters that are neither letters nor digits (of lower-cased text).
_OTHER = [*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]
#: A run of those from its first one that is no space; _DIGITS: a run of digits.
_RUN = f"{_listed(c for c in _OTHER if c != 0x20)}{_listed(_OTHER)}*+"
_DIGITS = f"{_listed(range(0x30, 0x3A))}++"


def _let(value: Column, then) -> Column:
    """then(value), with `value` made once."""
    return F.transform(F.array(value), then)[0]


def normalised(line: Column) -> Column:
    one = lambda t: F.when(F.contains(t, F.lit("  ")), F.regexp_replace(t, " ++", " ")).otherwise(t)
    return F.trim(F.regexp_replace(_let(F.regexp_replace(F.lower(line), _RUN, " "), one), _DIGITS, "0"))


def _thirds(text: Column, start: Column, size: Column, third: Column) -> list[Column]:
    """Hashes of the thirds of `size` bytes from `start` (1 is the first)."""
    return [F.xxhash64(F.lit(i), F.substring(text, start + third * i, third if i < 2 else size - third * 2)) for i in range(3)]


def _majority(h) -> Column:
    """The bits that are set in two of three hashes."""
    return h[0].bitwiseAND(h[1]).bitwiseOR(h[2].bitwiseAND(h[0].bitwiseOR(h[1])))


def simhash(text: Column, start: Column, size: Column) -> Column:
    """64-bit SimHash of `size` bytes from `start`: a bit is set if it is in two of the thirds' hashes."""
    return _let(F.array(*_thirds(text, start, size, F.floor(size / 3).cast("int"))), _majority)


def with_keys(df: DataFrame, text: str, similarity: float = SIMILARITY) -> DataFrame:
    """`df` with `size`, the length of the normal form in column `text`, and `keys`, all its keys as an array of longs.

    Parts are cut by bytes, which needs no look at the characters before them.
    Lengths, widths and hashes are columns of their own, so that each is made once, and
    in compiled code: functions of array elements are interpreted, which took twice the time.
    """
    kept, t, n = df.columns, F.col("bytes"), F.col("n")
    one, two = round(1 / (1 - similarity)), math.ceil(2 / (1 - similarity) - 1e-9)  # lengths from which one and two edits are allowed
    step = lambda size: F.floor(F.log(F.greatest(size, F.lit(1.0))) / math.log(STEP) + 1e-9).cast("int")
    df = df.withColumns({"size": F.length(text), "bytes": F.col(text).cast("binary"), "n": F.octet_length(text)})
    # a partner may be longer by the allowed edits, so it may be of the next step
    df = df.withColumns({"step0": step(n.cast("double")), "step1": step(n / similarity + _WIDEST)})
    width = lambda s: F.floor(F.pow(F.lit(STEP), F.col(s)) * SHARE).cast("int")
    long = n >= math.ceil(two * similarity - 1e-9)
    used = {0: long, 1: long & (F.col("step1") != F.col("step0"))}
    df = df.withColumns({f"w{k}": F.when(used[k], width(f"step{k}")) for k in used})
    third = lambda size: F.floor(size / 3).cast("int")
    df = df.withColumns({f"t{k}": third(F.col(f"w{k}")) for k in used} | {f"m{k}": third(n - 4 * F.col(f"w{k}")) for k in used})
    hashes = {}
    for k in used:
        w, at_end, between = F.col(f"w{k}"), F.col(f"t{k}"), F.col(f"m{k}")
        parts = [(F.lit(1), w, at_end), (w + 1, w, at_end), (2 * w + 1, n - 4 * w, between), (n - 2 * w + 1, w, at_end), (n - w + 1, w, at_end)]
        hashes |= {f"h{k}{j}{i}": h for j, part in enumerate(parts) for i, h in enumerate(_thirds(t, *part))}
    df = df.withColumns(hashes)
    df = df.withColumns({f"s{k}{j}": _majority([F.col(f"h{k}{j}{i}") for i in range(3)]) for k in used for j in range(5)})
    none = F.array().cast("array<bigint>")

    def of_step(k: int) -> Column:
        at = F.col(f"step{k}")
        key = lambda chosen: F.array(*[F.xxhash64(F.lit(i), at, *[F.col(f"s{k}{j}") for j in c]) for i, c in enumerate(chosen)])
        return (F.when(F.col(f"w{k}").isNull(), none).when(at >= SINGLES, key([(j,) for j in range(5)]))
                .when(at >= PAIRS, key([(0, 1), (2, 3), (2, 4), (3, 4)])).otherwise(key(list(itertools.combinations(range(5), 3)))))

    def halves(longer: Column) -> Column:
        h = F.floor((longer - _WIDEST) / 2).cast("int")
        return F.array(*[F.xxhash64(F.lit(100 + j), longer, simhash(t, start, h)) for j, start in enumerate((F.lit(1), n - h + 1))])

    longer = F.transform(F.sequence(F.lit(0), F.lit(_WIDEST)), lambda i: n + i)
    short = F.when((n >= one - 1) & (F.col("step0") < PAIRS), F.flatten(F.transform(longer, halves))).otherwise(none)
    df = df.withColumns({"k0": of_step(0), "k1": of_step(1), "k2": short})
    return df.select(*kept, "size", F.concat("k0", "k1", "k2").alias("keys"))


def _common(a: Column, b: Column, cut, most: int = 27) -> Column:
    """The number of bytes that a and b share at one end, by bisection; cut(bytes, n) takes n from that end."""
    room = F.least(F.octet_length(a), F.octet_length(b))
    return F.aggregate(F.array(*[F.lit(1 << i) for i in range(most, -1, -1)]), F.lit(0),
                       lambda n, p: F.when((n + p <= room) & (cut(a, n + p) == cut(b, n + p)), n + p).otherwise(n))


def _most(a: Column, b: Column, similarity: float) -> Column:
    """The edits allowed between lines of the lengths a and b."""
    return F.floor(F.greatest(a, b) * F.lit(1 - similarity) + F.lit(1e-9)).cast("int")


def _similar(a: Column, b: Column, most: Column) -> Column:
    """Whether the edit distance of the normal forms a and b is at most `most`."""
    head = lambda u, v: _common(u, v, lambda t, n: F.substring(t, F.lit(1), n))
    tail = lambda u, v: _common(u, v, lambda t, n: F.substring(t, F.octet_length(t) - n + 1, n))
    # whole characters of both ends: a character that is cut counts for up to three, and the ends must not meet
    chars = lambda t: F.length(t.cast("string"))

    def ends(u: Column, n: Column, m: Column) -> Column:
        return F.struct(F.greatest(chars(F.substring(u, F.lit(1), n)) - 1, F.lit(0)).alias("h"),
                        F.greatest(chars(F.substring(u, F.octet_length(u) - m + 1, m)) - 3, F.lit(0)).alias("z"))

    def middles(e: Column) -> Column:
        room = F.least(F.length(a), F.length(b)) - e["h"]
        middle = lambda t: F.substring(t, e["h"] + 1, F.length(t) - e["h"] - F.least(e["z"], room))
        return F.struct(middle(a).alias("x"), middle(b).alias("y"))

    def near(m: Column) -> Column:
        x, y = m["x"], m["y"]
        within = lambda n: F.call_function("levenshtein", x, y, n) >= 0
        # the band that is searched grows with the limit, and most linked pairs are far nearer than it
        return (F.when(F.greatest(F.length(x), F.length(y)) <= most, True)
                .when(within(F.least(most, F.lit(4))), True).when(most <= 4, False)
                .when(within(F.least(most, F.lit(16))), True).when(most <= 16, False)
                .when(within(F.least(most, F.lit(128))), True).when(most <= 128, False).otherwise(within(most)))

    both = F.struct(a.cast("binary").alias("u"), b.cast("binary").alias("v"))
    cut = _let(both, lambda t: _let(F.struct(head(t["u"], t["v"]).alias("n"), tail(t["u"], t["v"]).alias("m")), lambda n: ends(t["u"], n["n"], n["m"])))
    return _let(_let(cut, middles), near)


def _letters(text: Column) -> Column:
    """How often each letter from a to z is in `text`."""
    return F.transform(F.array(*map(F.lit, string.ascii_lowercase)), lambda c: F.octet_length(text) - F.octet_length(F.replace(text, c, F.lit(""))))


def _apart(a: Column, b: Column, most: Column) -> Column:
    """Whether letter counts alone need over `most` edits: an edit takes one character away at most and adds one at most."""
    more = lambda x, y: F.aggregate(F.zip_with(x, y, lambda i, j: F.greatest(i - j, F.lit(0))), F.lit(0), lambda n, i: n + i)
    return (more(a, b) > most) | (more(b, a) > most)


def _linked(pairs: DataFrame, lines: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose normal forms are similar."""
    side = lambda x: lines.select(F.col("c").alias(x), F.col("norm").alias(f"norm_{x}"))
    a, b = F.length("norm_a"), F.length("norm_b")
    most = _most(a, b, similarity)
    return pairs.join(side("a"), "a").join(side("b"), "b").where((F.abs(a - b) <= most) & _similar(F.col("norm_a"), F.col("norm_b"), most)).select("a", "b")


def _different(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs (a, b) that are in different groups."""
    root_of = lambda x: roots.select(F.col("c").alias(x), F.col("root").alias(f"root_{x}"))
    both = pairs.join(root_of("a"), "a", "left").join(root_of("b"), "b", "left")
    return both.where(F.coalesce("root_a", "a") != F.coalesce("root_b", "b")).select("a", "b")


def _placed(members: DataFrame, roots: DataFrame) -> DataFrame:
    return members.join(roots, "c", "left").select("key", "c", "size", F.coalesce("root", "c").alias("root"))


def _looks(members: DataFrame, roots: DataFrame, mix: int) -> DataFrame:
    """Pairs (a, b): in each bucket every class outside the largest group with up to four of that group."""
    placed = keep(_placed(members, roots), "placed")
    mixed = F.col("c").bitwiseXOR(F.lit(mix))
    picks = F.array(F.min("c"), F.max("c"), F.min(mixed).bitwiseXOR(F.lit(mix)), F.max(mixed).bitwiseXOR(F.lit(mix)))
    of_root = placed.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n"), picks.alias("picks"))
    main = of_root.groupBy("key").agg(F.max(F.struct("n", "root", "picks")).alias("main"), F.count(F.lit(1)).alias("roots")).where("roots > 1 AND main.n > 1").drop("roots")
    stray = placed.join(main, "key").where("root != main.root").select(F.explode(F.array_distinct("main.picks")).alias("p"), "c")
    return keep(stray.select(F.least("p", "c").alias("a"), F.greatest("p", "c").alias("b")).distinct(), "looks")


def _across(members: DataFrame, roots: DataFrame, lines: DataFrame, similarity: float) -> DataFrame:
    """The similar pairs (a, b) of a bucket that are in different groups.

    `members`: key, c, size; `roots`: c, root of the classes that are not alone.
    In each bucket the classes outside its largest group meet all classes of
    other groups that are near enough in length; buckets with the same classes
    are looked at once, and so is a pair that shares several. Lines are dealt
    by bucket, length and parts of the strays, and compared in the join, so only links come out of it.
    """
    placed = keep(_placed(members, roots), "placed")
    of_root = placed.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("c")).alias("x"))
    mixed = (of_root.groupBy("key").agg(F.max(F.struct("n", "root")).alias("most"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("roots"), F.bit_xor("x").alias("x"))
             # of three classes two were the pivots of the third
             .where("roots > 1 AND n > 3").groupBy("x", "n").agg(F.min(F.struct("key", "most")).alias("b"))
             .select("b.key", F.col("b.most.root").alias("main")))
    here = keep(placed.join(mixed, "key"), "mixed")
    # similar lines are of the same band of lengths or of neighbouring ones
    band = F.floor(F.log(F.col("size").cast("double")) / (2 * math.log(1 / similarity))).cast("int")
    of_class = keep(here.groupBy("c").agg(F.collect_set("key").alias("keys")).join(lines, "c").withColumn("letters", _letters(F.col("norm"))), "mixed-lines")
    here = here.withColumn("band", band).join(of_class, "c")
    side = lambda x: [F.col(k).alias(f"{k}_{x}") for k in ("root", "size", "keys", "letters", "norm")] + [F.col("c").alias(x)]
    stray = here.where("root != main")
    cells = keep(stray.groupBy("key", "band").agg(F.ceil(F.sum("size") / STRAYS).cast("int").alias("parts")), "cells")
    stray = stray.join(cells, ["key", "band"]).select("key", "main", "band", F.pmod(F.xxhash64("c"), "parts").cast("int").alias("part"), *side("a"))
    other = here.withColumn("band", F.explode(F.array(*[F.col("band") + i for i in (-1, 0, 1)]))).join(cells, ["key", "band"])
    other = other.select("key", "band", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), *side("b"))
    # two strays meet once
    once = (F.col("root_b") == F.col("main")) | (F.col("a") < F.col("b"))
    first = F.array_min(F.array_intersect("keys_a", "keys_b")) == F.col("key")
    most = _most(F.col("size_a"), F.col("size_b"), similarity)
    near = (F.abs(F.col("size_a") - F.col("size_b")) <= most) & first & ~_apart(F.col("letters_a"), F.col("letters_b"), most)
    return keep(stray.join(other, ["key", "band", "part"]).where((F.col("root_a") != F.col("root_b")) & once & near & _similar(F.col("norm_a"), F.col("norm_b"), most))
                .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), "links")


def _merged(roots: DataFrame, links: DataFrame) -> DataFrame:
    """`roots` (c, root) after more links (a, b) between classes."""
    root_of = lambda x: roots.select(F.col("c").alias(x), F.col("root").alias(f"root_{x}"))
    top = components(links.join(root_of("a"), "a", "left").join(root_of("b"), "b", "left")
                     .select(F.coalesce("root_a", "a").alias("a"), F.coalesce("root_b", "b").alias("b"))).toDF("t", "top")
    every = roots.unionByName(top.join(roots, top["t"] == roots["c"], "left_anti").select(F.col("t").alias("c"), F.col("t").alias("root")))
    return keep(every.join(top, every["root"] == top["t"], "left").select("c", F.coalesce("top", "root").alias("root")), "roots")


def _groups(classes: DataFrame, lines_of, similarity: float) -> DataFrame:
    """(c, root) of every class in a connected group of several classes; `classes`: c, size, keys."""
    keys = classes.select("c", "size", F.explode("keys").alias("key"))
    shared = keep(keys.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.array(F.min("c"), F.max("c")).alias("pivots")).where("n > 1").drop("n"), "shared-keys")
    member = keep(keys.join(shared, "key"), "buckets")
    low = keep(member.select(F.col("pivots")[0].alias("a"), F.col("c").alias("b")).where("a != b").distinct(), "low-pairs")
    high = member.select(F.col("c").alias("a"), F.col("pivots")[1].alias("b")).where("a != b").distinct().join(low, ["a", "b"], "left_anti")
    lines = keep(lines_of(member.select("c").distinct()), "candidate-lines")
    roots = keep(components(keep(_linked(low, lines, similarity), "links")).toDF("c", "root"), "roots")
    # of the pairs with the last class only those that the first has left apart
    roots = _merged(roots, keep(_linked(keep(_different(high, roots), "high-pairs"), lines, similarity), "links"))
    member = member.drop("pivots")
    for i in range(LOOKS):
        roots = _merged(roots, keep(_linked(_looks(member, roots, 0x2AAAAAAAA >> i), lines, similarity), "links"))
    return _merged(roots, _across(member, roots, lines, similarity))


def _hashed(norm: Column, h: Column) -> Column:
    """`h`, but null for a line with nothing to compare."""
    return F.when(norm != "", h)


def occurrences(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """A row for every line: rid (row of `docs`), doc_id, line_no from 0 (null: null text), kept, and `first`,
    the occurrence (doc_id, line_no, rid) that stands for the line's group (null: not compared)."""
    text = F.col("text").cast("string")
    norm = F.col("norm")
    h1, h2 = _hashed(norm, F.xxhash64("norm")).alias("h1"), _hashed(norm, F.xxhash64(F.lit(1), "norm")).alias("h2")
    rows = docs.select("doc_id", text.alias("text"), F.monotonically_increasing_id().alias("rid"), F.xxhash64(text).alias("th"))
    # normal forms are made inside the generator, so that each is made once
    lines = rows.select("rid", "doc_id", "th", F.posexplode_outer(F.transform(F.split("text", "\n", -1), normalised)).alias("line_no", "norm"))
    # a text's hash goes with its first line
    hashed = lines.select("rid", "doc_id", F.when(F.col("line_no") == 0, F.col("th")).alias("th"), "line_no", h1, h2, "norm")
    found = keep(with_keys(hashed, "norm", similarity).drop("norm"), "lines")
    who = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "line_no", "rid", "size", "keys")
    classes = keep(found.where("h1 is not null").groupBy("h1", "h2").agg(F.min(who).alias("who"))
                   .withColumn("c", F.monotonically_increasing_id()), "line-classes")

    def lines_of(some: DataFrame) -> DataFrame:
        """(c, norm) of the classes `some`, from the lines that stand for them."""
        wanted = keep(classes.select("c", "h1", "h2", "who.doc_id", "who.line_no").join(some, "c"), "wanted")
        # a bitmap of fixed size over (doc_id, line_no) refuses most lines before they are normalised and shuffled
        place = F.xxhash64("doc_id", "line_no")
        slot, bit = F.shiftrightunsigned(place, 48), place.bitwiseAND(F.lit(63)).cast("int")
        used = wanted.groupBy(slot.alias("id")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), bit)).alias("bits"))
        slots = docs.sparkSession.range(1 << 16).join(used, "id", "left").agg(F.array_sort(F.collect_list(F.struct("id", F.coalesce("bits", F.lit(0)).alias("bits")))).alias("a"))
        bitmap = slots.select(F.transform("a", lambda x: x["bits"])).scalar()
        is_set = F.call_function("shiftrightunsigned", F.element_at(bitmap, slot.cast("int") + 1), bit).bitwiseAND(F.lit(1)) == 1
        raw = rows.select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line")).where(is_set)
        again = raw.select(F.explode(F.array(normalised(F.col("line")))).alias("norm")).select("norm", h1, h2)
        return again.join(wanted.select("c", "h1", "h2"), ["h1", "h2"]).select("c", "norm").dropDuplicates(["c"])

    groups = _groups(classes.select("c", "who.size", "who.keys"), lines_of, similarity)
    own = classes.select("h1", "h2", F.struct("who.no_id", "who.doc_id", "who.line_no", "who.rid").alias("own"), "c")
    # a class that is alone stands for itself
    grouped = keep(groups.join(own.select("c", "own"), "c"), "grouped")
    first = grouped.groupBy("root").agg(F.min("own").alias("first"))
    of_class = own.join(grouped.select("c", "root").join(first, "root").drop("root"), "c", "left").select("h1", "h2", F.coalesce("first", "own").alias("first"))
    mine = (F.col("first.rid") == F.col("rid")) & (F.col("first.line_no") == F.col("line_no"))
    return found.drop("size", "keys").join(of_class, ["h1", "h2"], "left").select(
        "rid", "doc_id", "th", "line_no", (F.col("first").isNull() | mine).alias("kept"), "first")


def _per_row(found: DataFrame) -> DataFrame:
    marks = F.sort_array(F.collect_list(F.struct("line_no", "kept", F.struct("first.doc_id", "first.line_no").alias("first"))))
    return found.groupBy("rid").agg(F.first("doc_id").alias("doc_id"), F.max("th").alias("th"), F.max("line_no").alias("last"), marks.alias("marks"))


def report(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One row per document: doc_id, n_lines, n_removed, removed (their numbers, comma-joined) and
    groups_sha256, the hash of doc_id:line_no of the line that stands for each of its lines."""
    gone = F.transform(F.filter("marks", lambda m: ~m["kept"]), lambda m: m["line_no"].cast("string"))
    stands = F.transform("marks", lambda m: F.concat_ws(":", F.coalesce(m["first"]["doc_id"].cast("string"), F.lit("")), F.coalesce(m["first"]["line_no"].cast("string"), F.lit(""))))
    return _per_row(occurrences(docs, similarity)).select(
        "doc_id", (F.coalesce("last", F.lit(-1)) + 1).cast("bigint").alias("n_lines"), F.size(gone).cast("bigint").alias("n_removed"),
        F.array_join(gone, ",").alias("removed"), F.sha2(F.array_join(stands, ","), 256).alias("groups_sha256"))


def dedup_lines(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """`docs` without the removed lines; a document that loses lines and keeps none but blank ones goes."""
    names = docs.columns
    doc_id, text = (f"c{names.index(c)}" for c in ("doc_id", "text"))
    # rows that share id and text are interchangeable: the i-th of them gets the i-th set of marks
    same = Window.partitionBy("_th", "_id")
    marks = (_per_row(occurrences(docs, similarity)).select(F.col("doc_id").alias("_id"), F.col("th").alias("_th"), "rid", F.col("marks.kept").alias("_kept"))
             .withColumn("_nth", F.row_number().over(same.orderBy("rid"))).drop("rid").toDF("m_id", "m_th", "_kept", "m_nth")
             .where(F.exists("_kept", lambda k: ~k)))
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    value = F.col(text).cast("string")
    plain = plain.withColumn("_id", F.col(doc_id)).withColumn("_th", F.when(value.isNotNull(), F.xxhash64(value))).withColumn("_nth", F.row_number().over(same.orderBy(F.lit(1))))
    both = plain.join(marks, (plain["_th"] == marks["m_th"]) & plain["_id"].eqNullSafe(marks["m_id"]) & (plain["_nth"] == marks["m_nth"]), "left")
    left = F.filter(F.split(value, "\n", -1), lambda x, i: F.col("_kept")[i])
    cut = F.col("_kept").isNotNull()
    both = both.withColumn("_text", F.when(cut, F.array_join(left, "\n")).otherwise(value))
    both = both.where(~cut | (normalised(F.col("_text")) != ""))
    return both.select(*[F.col("_text").alias(c) if c == text else F.col(c) for c in plain.columns[:len(names)]]).toDF(*names)
