"""Line dedup with a segment-partition edit join, in DataFrame functions only.

A line within ``k`` edits of another keeps one of the other's ``k + 1`` segments unchanged, at a place that the lengths
and the segment's number bound. So every line of ``least`` code points or more is indexed by its segments, and probes the
segments of lines as long as itself or up to ``k`` shorter with the substrings that can match them. Lines that meet are compared:
what both begin and end with is cut off, and a banded bit-parallel edit distance runs over the rest.

A line goes when an equal line, or one within ``k`` edits, stands earlier; earlier is by ``doc_id``, then line number. To
know that, a line need not be compared with all that it meets: first it is compared with the earliest line under each key; only lines
that this leaves are compared with the others. Letter counts tell most lines apart before. Equal lines are one from the start.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from presslake.llm.common import unused
from presslake.sources.workspace import materialize

#: Edits that make two lines near, and the code points from which on lines are compared; shorter ones only when equal.
EDITS, LEAST = 2, 24
#: Line numbers that are sent to every task to fetch their texts (8 bytes each); more of them are joined.
SENT = 1_000_000
BLANKS = " \t\r"
#: Letters that lines are told apart by before they are compared; any would do.
LETTERS = "abcdefghijklmnopqrstuvwxyz"


def lines_of(docs: DataFrame) -> DataFrame:
    r"""``doc_id, line_no, line, id`` of all lines that hold more than blanks; cut at ``\n``, blanks at the end dropped.

    ``id`` is an even 64-bit hash of the line, its name in the search for near lines.
    """
    cut = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    held = cut.withColumn("line", F.rtrim("line", F.lit(BLANKS))).filter(F.trim("line", F.lit(BLANKS)) != "")
    return held.withColumn("id", F.xxhash64("line").bitwiseAND(F.lit(-2).cast("long")))


def _segment(length: Column, i: int, k: int) -> tuple[Column, Column]:
    """Start (from 1) and length of segment ``i`` (from 0) of a line: as even as can be, the last ones longer."""
    size = F.call_function("div", length, F.lit(k + 1)).cast("int")
    short = F.lit(k + 1) - length % (k + 1)
    return F.lit(i) * size + F.greatest(F.lit(0), F.lit(i) - short) + 1, size + (F.lit(i) >= short).cast("int")


def postings(lines: DataFrame, k: int) -> DataFrame:
    """``key, id`` of distinct ``line, id``: the line's segments (``id`` odd) and the substrings that probe for others'.

    A key is a hash of the length of the indexed line, the segment's number and the segment. A line's own segments are
    also its probes for lines of its length. Lines have more than ``2k`` code points, so no probe reaches outside.
    """
    n = F.char_length("line")
    keys = []
    for shorter in range(k + 1):
        for i in range(k + 1):
            start, size = _segment(n - shorter, i, k)
            # With i edits at most before the segment, and k - i behind it, it can have moved by so much.
            for moved in range(max(-i, shorter - (k - i)), min(i, shorter + (k - i)) + 1):
                key = F.xxhash64(n - shorter, F.lit(i), F.substring("line", start + moved, size))
                named = F.col("id").bitwiseOR(F.lit(int(shorter == 0 and moved == 0)).cast("long"))
                keys.append(F.struct(key.alias("key"), named.alias("id")))
    return lines.select(F.inline(F.array(*keys)))


def signature(line: Column, k: int) -> dict[str, Column]:
    """How often a line has each letter, packed (``s``, eight bits each), and a hash of each of ``2k + 1`` groups of letters (``b``).

    An edit changes the counts by two at most, so near lines differ by ``2k`` at most, and agree in one group of letters
    at least. Counts are of the lower-cased line and stop at 255: both can only bring lines closer.
    """
    low = F.lower(line)
    counts = [F.least(F.char_length(low) - F.char_length(F.replace(low, F.lit(c), F.lit(""))), F.lit(255)).cast("long") for c in LETTERS]
    packed = {}
    for word in range(0, len(LETTERS), 7):
        part = counts[word : word + 7]
        packed[f"s{word // 7}"] = sum((F.shiftleft(c, 8 * j) for j, c in enumerate(part[1:], 1)), part[0])
    groups = F.array(*[F.xxhash64(F.lit(g), *counts[g :: 2 * k + 1]) for g in range(2 * k + 1)])
    return packed | {"groups": groups}


def _apart(a: str, b: str) -> str:
    """SQL: by how much the letter counts of two signatures differ."""
    one = lambda side, k: f"(shiftright({side}.s{k // 7}, {8 * (k % 7)}) & 255L)"
    return " + ".join(f"abs({one(a, k)} - {one(b, k)})" for k in range(len(LETTERS)))


def _common(a: str, b: str, end: str) -> str:
    """SQL: how many code points two strings have in common at an end (``left`` or ``right``), by halving."""
    steps = "transform(sequence(0, 30), x -> 1 << (30 - x))"
    return f"aggregate({steps}, 0, (n, p) -> if(p <= least(char_length({a}), char_length({b})) - n AND {end}({a}, n + p) = {end}({b}, n + p), n + p, n))"


def edit_distance(pairs: DataFrame, a: str, b: str, k: int) -> DataFrame:
    """``pairs`` with ``distance`` of their columns ``a`` and ``b`` where it is at most ``k``, else more than ``k``.

    The distance lies between the common beginning and the common end. There it is computed bit-parallel in a band
    of ``2k + 1`` rows: bit ``t`` of column ``j`` stands for row ``j - k + t``; ``vp`` and ``vn`` are the rows that are one more
    or less than the row above. ``d`` follows the band's lowest row, then the matrix's last row. Both strings get ``k`` equal
    characters in front, so that the lowest row starts inside.
    """
    # Each step is a generated row of its own: merged into one expression, they would be computed anew at every use.
    step = lambda df, **named: df.select("*", F.inline(F.array(F.struct(*[F.expr(e).alias(n) for n, e in named.items()]))))
    begun = step(pairs, _n=_common(a, b, "left"))
    cut = step(begun, **{f"_{c}": f"substring({c}, _n + 1)" for c in (a, b)}).drop("_n")
    ended = step(cut, _n=_common(f"_{a}", f"_{b}", "right"))
    chars = {f"_c{c}": f"concat(array_repeat('', {k}), regexp_extract_all(left(_{c}, char_length(_{c}) - _n), '(?s).', 0))" for c in (a, b)}
    ready = step(ended, **chars).drop("_n", f"_{a}", f"_{b}")
    a, b = f"c{a}", f"c{b}"
    every, top = (1 << 2 * k + 1) - 1, 1 << 2 * k
    match = " | ".join(f"if(get(_{a}, j - 1 - {k} + {t}) <=> get(_{b}, j - 1), {1 << t}L, 0L)" for t in range(2 * k + 1))
    hp, hn = f"(s.vn | (~(d0 | s.vp) & {every}L))", "(d0 & s.vp)"
    bit = f"greatest(0, size(_{a}) - j + {k})"
    down = f"if((d0 & {top}L) = 0L, 1, 0)"
    along = f"(cast(shiftright({hp}, {bit}) & 1L AS int) - cast(shiftright({hn}, {bit}) & 1L AS int))"
    after = f"""named_struct('vp', {hn} | (~(shiftright(d0, 1) | {hp}) & {every}L), 'vn', shiftright(d0, 1) & {hp},
        'd', s.d + if(j + {k} <= size(_{a}), {down}, {along}))"""
    zero = f"((((x & s.vp) + s.vp) ^ s.vp) | x | s.vn) & {every}L"
    column = f"transform(array({match}), x -> transform(array({zero}), d0 -> {after})[0])[0]"
    start = f"named_struct('vp', {((1 << k + 1) - 1) << k}L, 'vn', 0L, 'd', {k})"
    band = f"aggregate(sequence(1, size(_{b})), {start}, (s, j) -> {column}, s -> s.d)"
    distance = f"if(abs(size(_{a}) - size(_{b})) > {k}, {k + 1}, {band})"
    return ready.withColumn("distance", F.expr(distance)).drop(f"_{a}", f"_{b}")


def _place(row: str = "") -> Column:
    return F.struct(F.col(f"{row}doc_id"), F.col(f"{row}line_no"))


def near_lines(docs: DataFrame, firsts: DataFrame, k: int, least: int) -> DataFrame:
    """``id`` of lines that have a line within ``k`` edits at an earlier place; ``firsts`` has ``id, doc_id, line_no``.

    Lines that share a key are told apart by their letter counts inside the join. Beyond the comparison with the earliest
    line, only lines that agree in a whole group of letters meet, so a segment that many different lines have costs little.
    """
    if least <= 2 * k:
        raise ValueError("lines need more than 2k code points to be cut into segments")
    lines = lines_of(docs).filter(F.char_length("line") >= least)
    by_key = Window.partitionBy("key")
    name = F.col("id").bitwiseAND(F.lit(-2).cast("long"))
    spread = {"low": F.min(name).over(by_key), "high": F.max(name).over(by_key), "any": F.max(F.col("id").bitwiseAND(F.lit(1).cast("long"))).over(by_key)}
    meeting = postings(lines.select("line", "id").distinct(), k).withColumns(spread).filter("low <> high AND any = 1")
    met = materialize(meeting.select("key", name.alias("id"), (F.col("id") != name).alias("indexed")), "postings")
    names = materialize(met.select("id").distinct(), "met")
    if names.count() <= SENT:
        names = F.broadcast(names)
    texts = materialize(lines.select("id", "line").join(names, "id", "left_semi").distinct(), "texts")
    marks = texts.select("id", *[c.alias(n) for n, c in signature(F.col("line"), k).items()])
    places = firsts.select("id", _place().alias("place"))
    placed = materialize(met.join(marks.join(places, "id"), "id"), "placed")
    alike = f"{_apart('x', 'y')} <= {2 * k}"

    def near(pairs: DataFrame) -> DataFrame:
        left = pairs.join(texts.select(F.col("id").alias("early"), F.col("line").alias("a")), "early")
        both = left.join(texts.select(F.col("id").alias("late"), F.col("line").alias("b")), "late")
        return materialize(edit_distance(both, "a", "b", k).filter(F.col("distance") <= k).select(F.col("late").alias("id")).distinct(), "near")

    packed = [c for c in placed.columns if c[0] == "s"]
    earliest = placed.groupBy("key").agg(F.min(F.struct("place", "id", *packed)).alias("hub")).select("key", "hub.*")
    to_hub = placed.alias("x").join(earliest.alias("y"), F.expr(f"x.key = y.key AND x.id <> y.id AND {alike}"))
    found = near(to_hub.select(F.col("y.id").alias("early"), F.col("x.id").alias("late")).distinct())
    grouped = placed.select("key", "id", "place", "indexed", *packed, F.explode("groups").alias("letters"))
    rest = grouped.join(found, "id", "left_anti").alias("x")
    same = f"x.key = y.key AND x.letters = y.letters AND y.place < x.place AND (x.indexed OR y.indexed) AND {alike}"
    open_ = rest.join(grouped.alias("y"), F.expr(same)).select(F.col("y.id").alias("early"), F.col("x.id").alias("late"))
    return found.unionByName(near(open_.distinct()))


def line_places(docs: DataFrame, k: int = EDITS, least: int = LEAST) -> DataFrame:
    """``line_key, doc_id, line_no, near`` of every distinct line at its earliest place; ``near`` ones go as well."""
    lines = lines_of(docs).select(F.unhex(F.md5(F.col("line").cast("binary"))).alias("line_key"), "id", _place().alias("place"))
    # Summed up in the tasks first, so a line that a third of all rows have costs a row per task.
    first = materialize(lines.groupBy("line_key", "id").agg(F.min("place").alias("place")).select("line_key", "id", "place.*"), "lines")
    near = near_lines(docs, first, k, least).distinct().withColumn("near", F.lit(True))
    return first.join(near, "id", "left").select("line_key", "doc_id", "line_no", F.coalesce("near", F.lit(False)).alias("near"))


def line_report(docs: DataFrame, k: int = EDITS, least: int = LEAST) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_lines, n_exact, n_near, n_kept, kept_md5``.

    Of the lines that hold more than blanks, ``n_exact`` are equal to an earlier line, ``n_near`` are the first of their
    kind but within ``k`` edits of an earlier line, and ``n_kept`` stay; ``kept_md5`` is over the kept lines' MD5s in hex, in
    order. Null and empty texts have no lines. Rows that share a ``doc_id`` are one document whose lines stand at the same
    places; they get the same figures but for ``n_lines`` and ``n_exact``. Other columns are ignored.
    """
    kept = F.filter(F.sort_array(F.collect_list(F.struct("line_no", "line_key", "near"))), lambda x: ~x["near"])
    hexes = F.transform(kept, lambda x: F.lower(F.hex(x["line_key"])))
    places = line_places(docs, k, least).groupBy("doc_id").agg(F.sum(F.col("near").cast("long")).alias("near"), hexes.alias("kept"))
    n = F.size(F.filter(F.split("text", "\n"), lambda line: F.trim(line, F.lit(BLANKS)) != ""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.when(F.col("text").isNull(), 0).otherwise(n), F.lit(0)).cast("long").alias("n_lines"))
    met = rows.alias("r").join(places.alias("p"), F.col("r.doc_id").eqNullSafe(F.col("p.doc_id")), "left")
    near, stay = F.coalesce("near", F.lit(0)), F.coalesce(F.size("kept"), F.lit(0)).cast("long")
    stay = F.when(F.col("kept").isNull(), 0).otherwise(stay)
    return met.select(
        "r.doc_id",
        "n_lines",
        (F.col("n_lines") - near - stay).alias("n_exact"),
        near.alias("n_near"),
        stay.alias("n_kept"),
        F.md5(F.concat_ws("", F.coalesce("kept", F.array().cast("array<string>"))).cast("binary")).alias("kept_md5"),
    )


def dedup_lines(docs: DataFrame, k: int = EDITS, least: int = LEAST) -> DataFrame:
    """``docs`` with all their columns and only the kept lines, and blank lines, in ``text``; a null text stays null."""
    kept, own = unused(docs.columns, "kept", "own")
    places = line_places(docs, k, least).filter("NOT near").groupBy(F.col("doc_id").alias(own)).agg(F.collect_list("line_no").alias(kept))
    met = docs.join(places, docs["doc_id"].cast("long").eqNullSafe(F.col(own)), "left")
    stays = lambda line, i: F.coalesce(F.array_contains(kept, i), F.lit(False)) | (F.trim(line, F.lit(BLANKS)) == "")
    text = F.array_join(F.filter(F.split("text", "\n"), stays), "\n")
    return met.withColumn("text", text).select(*docs.columns)
