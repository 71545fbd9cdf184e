"""Line de-duplication across documents: exact repeats, and near repeats by a segment-partition edit join.

A line is dropped when an equal line comes earlier (by doc_id, then by place), or when it is at least ``min_chars`` long and
some line that first comes earlier, of whatever length, is near it: within ``max_edits`` single-character edits, or, where the
longer of the two has more than that many times ``EDIT_CHARS`` characters, one edit for every ``EDIT_CHARS`` of them (at most
``MOST_EDITS``). Blank lines are always kept. Near lines, directly or through others, form a class.

The edit join works on distinct lines, in two length classes. Short lines are cut into max_edits + 1 segments of even length;
lines within max_edits edits share a segment at almost the same place. Lines are indexed by (length, segment number, segment) and
probe the indexes of equal and up to max_edits smaller lengths with the few substrings that can match there. Candidates are
verified by a banded bit-parallel edit distance on what is left between their common prefix and suffix.

For long lines the number of such substrings would grow with the cube of the edits. There k + 1 segments, of a length that depends
on the edits k alone, are counted from both ends of the longer line, and the other line holds one of them as it is, moved by at
most its number. Places are anchors if a space or ``WORD`` other characters stand before them; every segment is indexed by (k,
segment number, substring at its first anchor), and a line probes with the substrings at those of its own anchors that the
segment's first one may have moved to. Keys are made and joined a part of the segments at a time, and candidates are verified,
by a banded edit distance on what differs, a part of the pairs at a time: of keys and of copies of lines, only one part's are on
disk. All of it is DataFrame expressions.

Shorter lines than ``min_chars`` are dropped only as exact repeats: a few edits would change most of them. Keys shared by very many lines are skewed join
keys, which adaptive execution splits; no candidate is dropped. Null and empty texts have no lines. Rows that repeat a doc_id
are taken as one document's; rows without doc_id come before all others. An empty table gives no rows. Other columns
of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseload.llm.components import components
from caseload.llm import storage
from caseload.llm.storage import BROADCAST_IDS

MAX_EDITS = 2
MIN_CHARS = 20
#: Long lines: characters for each edit, and the edits allowed at most.
EDIT_CHARS = 40
MOST_EDITS = 40
#: Long lines: characters other than spaces after which a place is an anchor, if another such character follows.
WORD = 12
#: The keys of long lines are made and joined in this many parts, one after the other, so that only one part's rows are on disk.
PASSES = 4
#: Of what two long lines have in common at an end, less than two to this power bytes are taken off.
COMMON_BITS = 16
#: Characters of candidate pairs' lines that are on disk at a time; more, if the lines with candidates have more themselves.
PAIR_CHARS = 1 << 30
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Stands for a missing doc_id: below every 64-bit integer.
NO_ID = -(1 << 63) - 1


def stored(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """:func:`storage.stored`; the shuffle files of the write go when it ends."""
    conf = df.sparkSession.conf
    before = conf.get(_CLEANUP, None)
    conf.set(_CLEANUP, "true")
    try:
        return storage.stored(df, name, path)
    finally:
        conf.unset(_CLEANUP) if before is None else conf.set(_CLEANUP, before)


def _lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, place, line) of every line that is not blank, blank meaning spaces only."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.split(F.col(text_col), "\n").alias("all"))
    return rows.select("doc_id", F.posexplode("all").alias("place", "line")).where("trim(line) <> ''")


def _segment(length: Column, number: int, segments: int) -> tuple[Column, Column]:
    """Start (from 1) and length of segment ``number`` (from 0) of a line of the given length; the last ones are longer."""
    base = F.floor(length / segments).cast("int")
    short = segments - length % segments
    start = base * number + F.greatest(F.lit(number) - short, F.lit(0)) + 1
    return start, base + F.when(F.lit(number) >= short, 1).otherwise(0)


def _key(length: Column, number: int, piece: Column) -> Column:
    return F.xxhash64(length, F.lit(number), piece)


def index_keys(line: Column, max_edits: int) -> Column:
    """The keys under which a line is found."""
    length, segments = F.length(line), max_edits + 1
    return F.array(*[_key(length, k, F.substring(line, *_segment(length, k, segments))) for k in range(segments)])


def probe_keys(line: Column, max_edits: int) -> Column:
    """The keys that a line looks up to meet every line of its own or a smaller length within ``max_edits``."""
    segments, out = max_edits + 1, []
    for less in range(max_edits + 1):
        length = F.length(line) - less
        for k in range(segments):
            start, size = _segment(length, k, segments)
            # The segment moves by what was inserted or deleted before it, and what can still follow.
            lowest = max(-k, less - (max_edits - k))
            highest = min(k, less + (max_edits - k))
            for move in range(lowest, highest + 1):
                out.append(_key(length, k, F.substring(line, start + move, size)))
    return F.array(*out)


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once: a mere mention in several places would compute it in each."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _common(a: Column, b: Column, most: Column) -> Column:
    """Length of the longest common prefix, at most ``most``, by bisection."""
    def halve(s: Column, _: Column) -> Column:
        low, high = s["low"], s["high"]
        return _let(F.ceil((low + high) / 2).cast("int"), lambda middle: _let(
            F.left(a, middle) == F.left(b, middle), lambda same: F.struct(
                F.when(same, middle).otherwise(low).alias("low"), F.when(same, high).otherwise(middle - 1).alias("high"))))

    steps = F.sequence(F.lit(1), F.ceil(F.log2((most + 2).cast("double"))).cast("int") + 1)
    return F.aggregate(steps, F.struct(F.lit(0).alias("low"), most.alias("high")), halve, lambda s: s["low"])


def within_edits(longer: Column, shorter: Column, max_edits: int) -> Column:
    """Whether the edit distance is at most ``max_edits``; neither string is shorter than that, nor the second longer.

    What the strings have in common at either end is taken off, but for the ``max_edits`` characters that the band needs.
    """
    def without_prefix(prefix: Column) -> Column:
        return F.struct(F.substring(longer, prefix + 1, F.length(longer)).alias("a"),
                        F.substring(shorter, prefix + 1, F.length(shorter)).alias("b"))

    def without_suffix(s: Column) -> Column:
        suffix = _common(F.reverse(s["a"]), F.reverse(s["b"]), F.length(s["b"]) - max_edits)
        return _let(suffix, lambda n: F.struct(F.left(s["a"], F.length(s["a"]) - n).alias("a"),
                                               F.left(s["b"], F.length(s["b"]) - n).alias("b")))

    prefix = _common(longer, shorter, F.length(shorter) - max_edits)
    return _let(prefix, lambda n: _let(without_prefix(n), lambda s: _let(without_suffix(s), lambda t: _let(
        F.struct(F.split(t["a"], "").alias("text"), F.split(t["b"], "").alias("pattern")),
        lambda c: _band(c["text"], c["pattern"], max_edits)))))


def _band(text: Column, pattern: Column, max_edits: int) -> Column:
    """Whether two arrays of characters are within ``max_edits`` (the first as long as the second or longer).

    One machine word holds the vertical differences of the band around the diagonal (``vp`` of +1, ``vn`` of -1); a step over
    a character of the text updates all of them by bitwise operations. ``edits`` follows the band's lowest row, and after the
    pattern's end the last row, at the bit ``mark``.
    """
    width = 2 * max_edits + 2
    top, full = width - 1, (1 << width) - 1
    m = F.size(pattern)

    def step(s: Column, j: Column) -> Column:
        def matches(char: Column) -> Column:
            near = [F.get(pattern, j + (max_edits - top + k - 1)) == char for k in range(width)]
            return sum((F.when(hit, 1 << k).otherwise(0) for k, hit in enumerate(near)), F.lit(0))

        def diagonal(pm: Column) -> Column:
            return (pm.bitwiseAND(s["vp"]) + s["vp"]).bitwiseXOR(s["vp"]).bitwiseOR(pm).bitwiseOR(s["vn"]).bitwiseAND(F.lit(full))

        def horizontal(d0: Column) -> Column:
            return F.struct(s["vn"].bitwiseOR(F.bitwise_not(d0.bitwiseOR(s["vp"]))).bitwiseAND(F.lit(full)).alias("hp"),
                            d0.bitwiseAND(s["vp"]).alias("hn"), F.shiftright(d0, 1).alias("down"), d0.alias("d0"))

        def vertical(h: Column) -> Column:
            past = j > m - max_edits
            last_row = (F.when(h["hp"].bitwiseAND(s["mark"]) != 0, 1).otherwise(0)
                        - F.when(h["hn"].bitwiseAND(s["mark"]) != 0, 1).otherwise(0))
            grown = F.when(past, last_row).otherwise(F.when(h["d0"].bitwiseAND(F.lit(1 << top)) != 0, 0).otherwise(1))
            return F.struct(h["hn"].bitwiseOR(F.bitwise_not(h["down"].bitwiseOR(h["hp"]))).bitwiseAND(F.lit(full)).alias("vp"),
                            h["down"].bitwiseAND(h["hp"]).alias("vn"), (s["edits"] + grown).alias("edits"),
                            F.when(past, F.shiftright(s["mark"], 1)).otherwise(s["mark"]).alias("mark"))

        return _let(F.get(text, j - 1), lambda char: _let(matches(char), lambda pm: _let(
            diagonal(pm), lambda d0: _let(horizontal(d0), vertical))))

    start = F.struct(F.lit((full << (top - max_edits)) & full).alias("vp"), F.lit(0).alias("vn"), F.lit(max_edits).alias("edits"),
                     F.lit(1 << (top - 1)).alias("mark"))
    return F.aggregate(F.sequence(F.lit(1), F.size(text)), start, step, lambda s: s["edits"] <= max_edits)


def distinct_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Stored: line, id, and where it first comes (first_doc, first_place).

    One aggregation moves every distinct line once. Its only value is the least (doc_id, place), as one number, so that it
    is a hash aggregation of fixed size.
    """
    span = 1 << 32
    doc = F.coalesce(F.col("doc_id").cast("decimal(20,0)"), F.lit(Decimal(NO_ID)).cast("decimal(20,0)"))
    first = (doc * F.lit(span).cast("decimal(11,0)") + F.col("place")).cast("decimal(38,0)")
    firsts = _lines(docs, id_col, text_col).groupBy("line").agg(F.min(first).alias("first"))
    place = F.pmod("first", F.lit(span).cast("decimal(38,0)"))
    found = ((F.col("first") - place) / F.lit(span)).cast("decimal(20,0)")
    return stored(firsts.select("line", F.when(found != F.lit(Decimal(NO_ID)), found).cast("long").alias("first_doc"),
                                place.cast("int").alias("first_place"), F.monotonically_increasing_id().alias("id")), "lines")


def _long_from(max_edits: int) -> int:
    """The length from which a line may have more than ``max_edits`` edits."""
    return EDIT_CHARS * (max_edits + 1)


def allowed_edits(length: Column, max_edits: int) -> Column:
    """The edits allowed between two lines, the longer of which has the given length."""
    share = F.least(F.floor(length / EDIT_CHARS).cast("int"), F.lit(max(MOST_EDITS, max_edits)))
    return F.greatest(share, F.lit(max_edits))


def _classes(max_edits: int) -> range:
    """The numbers of edits that long lines may have."""
    most = max(MOST_EDITS, max_edits)
    return range(min(max_edits + 1, most), most + 1)


def _segment_size(edits, max_edits: int):
    """Characters of a segment: the shortest lines of the class consist of edits + 1 of them. ``edits``: column or number."""
    if isinstance(edits, int):
        return max(edits * EDIT_CHARS, _long_from(max_edits)) // (edits + 1)
    return F.floor(F.greatest(edits * EDIT_CHARS, F.lit(_long_from(max_edits))) / (edits + 1)).cast("int")


def _text_size(edits, max_edits: int):
    """Characters of a segment's key: what is left of it after its first anchor, wherever that is. ``edits``: column or number."""
    return _segment_size(edits, max_edits) - WORD - 1


def _first_text(segment: Column, size: Column) -> Column:
    """``size`` characters from the first anchor of a segment."""
    space = F.call_function("locate", F.lit(" "), segment)
    return F.substring(segment, F.when(space.between(1, WORD + 1), space + 1).otherwise(WORD + 1), size)


def _anchored_texts(text: Column, least: int, most: int) -> Column:
    """The ``most`` characters (at the end fewer, but ``least``) from every anchor of a text."""
    after, run = rf"(?=(.{{{least},{most}}}))", rf"[^ ]{{{WORD}}}"
    # Java looks behind by UTF-16 units; so where it meets second halves of surrogate pairs, every place is an anchor.
    both = rf"(?s)(?: |(?<={run}|[\uDC00-\uDFFF][^ ]{{0,{WORD}}})(?=[^ ])){after}"
    return F.when(text.rlike(f"{run}[^ ]"), F.regexp_extract_all(text, F.lit(both), F.lit(1))).otherwise(
        F.regexp_extract_all(text, F.lit(f"(?s) {after}"), F.lit(1)))


def _numbered(lines: DataFrame, part: int, max_edits: int) -> DataFrame:
    """The lines once for every ``number`` of their segments that is of the part; with the segments' length, and how many of
    them are counted from the line's start."""
    cut = lines.where(F.col("edits") >= part).withColumn("number", F.explode(F.sequence(F.lit(part), "edits", F.lit(PASSES))))
    return cut.withColumns({"front": F.floor(F.col("edits") / 2).cast("int") + 1, "length": _segment_size(F.col("edits"), max_edits),
                            "text_size": _text_size(F.col("edits"), max_edits)})


def _long_index(lines: DataFrame, max_edits: int, part: int) -> DataFrame:
    """(id, size, key): every long line by the text at the first anchor of each of its segments."""
    found = (lines.where(F.length("line") >= _long_from(max_edits)).select("id", "line", F.length("line").alias("size"))
             .withColumn("edits", allowed_edits(F.col("size"), max_edits)))
    cut = _numbered(found, part, max_edits)
    number, front, length = F.col("number"), F.col("front"), F.col("length")
    start = F.when(number < front, number * length).otherwise(F.col("size") - (number - front + 1) * length)
    cut = cut.withColumn("segment", F.substring(F.col("line"), start + 1, length))
    return cut.select("id", "size", F.xxhash64("edits", "number", _first_text(F.col("segment"), F.col("text_size"))).alias("key"))


def _long_probes(lines: DataFrame, max_edits: int, part: int) -> DataFrame:
    """(id, size, key): every line by the texts at the anchors where a segment of its own or a greater length may stand.

    Of k edits at most k / 2 are in the first half of the segments, or fewer than half as many as there are segments in the last.
    Seen from the outer end of that half, the first segment j up to whose end there are at most j edits is whole, and exactly j
    edits stand before it; so it moves by at most j from its place, which depends on the class alone.
    """
    start, most = _long_from(max_edits), max(MOST_EDITS, max_edits)
    found = (lines.where(F.length("line") >= start - (max_edits + 1)).select("id", "line", F.length("line").alias("size"))
             .withColumn("least", allowed_edits(F.greatest("size", F.lit(start)), max_edits)))
    # Longer lines near this one have as many edits, or one more.
    more = (F.col("least") < most) & (F.col("size") + F.col("least") + 1 >= (F.col("least") + 1) * EDIT_CHARS)
    found = found.withColumn("edits", F.explode(F.sequence("least", F.col("least") + more.cast("int"))))
    cut = _numbered(found, part, max_edits)
    number, front, length = F.col("number"), F.col("front"), F.col("length")
    before = F.when(number < front, number).otherwise(number - front)
    place = F.when(number < front, number * length).otherwise(F.col("size") - (before + 1) * length)
    cut = cut.withColumns({"low": F.greatest(place - before, F.lit(0)), "high": place + before}).where("low <= high")
    cut = cut.withColumn("around", F.substring(F.col("line"), F.col("low") + 1, F.col("high") - F.col("low") + length))
    # From wherever the segment starts, its first anchor does not come after the first space from its last start on.
    cut = cut.withColumn("space", F.call_function("locate", F.lit(" "), F.col("around"), F.col("high") - F.col("low") + 1))
    cut = cut.withColumn("around", F.when(F.col("space") > 0, F.left("around", F.col("space") + F.col("text_size"))).otherwise(F.col("around")))
    sizes = [_text_size(e, max_edits) for e in _classes(max_edits)]
    cut = cut.select("id", "size", "edits", "number", "text_size", F.explode(
        _anchored_texts(F.col("around"), min(sizes), max(sizes))).alias("text"))
    return (cut.where(F.length("text") >= F.col("text_size"))
            .select("id", "size", F.xxhash64("edits", "number", F.left("text", F.col("text_size"))).alias("key")))


def _long_candidates(lines: DataFrame, max_edits: int, folder: str | None = None) -> DataFrame:
    """Stored (under ``folder``): pairs (probe, id) of lines, the longer (or, of equally long ones, that of smaller id) first, where
    the one has a segment that the other holds about where it may have moved to; size: characters of the first."""
    less = F.col("a.size") - F.col("b.size")
    near = (F.col("a.id") != F.col("b.id")) & (less >= 0) & (less <= allowed_edits(F.col("a.size"), max_edits))
    first = (less > 0) | (F.col("a.id") < F.col("b.id"))
    parts = []
    folder = folder or storage.shared_folder(lines.sparkSession, "long-candidates")
    for part in range(PASSES):
        # Keys are made for the segments of one part at a time and are nowhere but in its shuffle, which goes when it is stored.
        index, probes = _long_index(lines, max_edits, part), _long_probes(lines, max_edits, part)
        both = index.alias("a").join(probes.alias("b"), (F.col("a.key") == F.col("b.key")) & near)
        pairs = both.select(F.when(first, F.col("a.id")).otherwise(F.col("b.id")).alias("probe"),
                            F.when(first, F.col("b.id")).otherwise(F.col("a.id")).alias("id"), F.col("a.size").alias("size"))
        parts.append(stored(pairs.distinct(), "long-candidates", f"{folder}/{part}"))
    return reduce(DataFrame.union, parts)


def _differing(a: Column, b: Column, use: Callable[[Column, Column], Column]) -> Column:
    """``use`` of two different strings without what they have in common at either end; their edit distance stays the same."""
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(COMMON_BITS))])
    first_inner, last_inner = F.expr("X'80'"), F.expr("X'BF'")

    def common(x: Column, y: Column, piece: Callable[[Column, Column, Column], Column]) -> Column:
        # In bytes, which are reached at once. Pieces beyond the end of one of the strings are never equal.
        return F.aggregate(steps, F.lit(0), lambda n, step: n + F.when(piece(x, n, step) == piece(y, n, step), step).otherwise(0))

    def of_characters(n: Column, byte: Callable[[Column], Column]) -> Column:
        # ``byte`` of n is that before which a cut would be: no cut before the inner bytes of a character.
        inner = [byte(n - k).between(first_inner, last_inner) for k in range(3)]
        return F.when(~inner[0], n).when(~inner[1], n - 1).when(~inner[2], n - 2).otherwise(F.greatest(n - 3, F.lit(0)))

    def ahead(x: Column, n: Column, step: Column) -> Column:
        return F.substring(x, n + 1, step)

    def behind(x: Column, n: Column, step: Column) -> Column:
        return F.substring(x, F.greatest(F.length(x) - n - step, F.lit(0)) + 1, F.least(step, F.length(x) - n))

    def without_prefix(s: Column) -> Column:
        return _let(common(s["a"], s["b"], ahead), lambda found: _let(
            of_characters(found, lambda n: F.substring(s["a"], n + 1, F.lit(1))),
            lambda n: F.struct(*[F.substring(s[c], n + 1, F.length(s[c])).alias(c) for c in "ab"])))

    def without_suffix(s: Column) -> Column:
        return _let(common(s["a"], s["b"], behind), lambda found: _let(
            of_characters(found, lambda n: F.substring(s["a"], F.length(s["a"]) - n + 1, F.lit(1))),
            lambda n: F.struct(*[F.substring(s[c], F.lit(1), F.length(s[c]) - n).cast("string").alias(c) for c in "ab"])))

    both = F.struct(a.cast("binary").alias("a"), b.cast("binary").alias("b"))
    return _let(without_prefix(both), lambda s: _let(without_suffix(s), lambda t: use(t["a"], t["b"])))


def near_pairs(lines: DataFrame, max_edits: int = MAX_EDITS, min_chars: int = MIN_CHARS, below: int = 0) -> DataFrame:
    """Stored: pairs (a, b) of ids of distinct lines (columns id, line) of at least ``min_chars - below`` characters that are near."""
    if min_chars < 2 * (max_edits + 1):
        raise ValueError("min_chars must leave every segment two characters")
    lines = lines.where(F.length("line") >= min_chars - below)
    short = lines.where(F.length("line") < _long_from(max_edits))
    index = short.select("id", F.explode(index_keys(F.col("line"), max_edits)).alias("key"))
    probes = short.select(F.col("id").alias("probe"), F.length("line").alias("size"),
                          F.explode(probe_keys(F.col("line"), max_edits)).alias("key"))
    met = probes.join(index, "key").where("probe <> id").select("probe", "id", "size")
    folder = storage.shared_folder(lines.sparkSession, "long-candidates")
    met = stored(met.union(_long_candidates(lines, max_edits, folder)).distinct(), "line-candidates")
    storage.discard(lines.sparkSession, folder)
    # Only lines with a candidate are looked at again; up to BROADCAST_IDS of their ids are broadcast.
    wanted = stored(met.select(F.explode(F.array("probe", "id")).alias("id")).distinct(), "line-ids")
    wanted = wanted.hint("broadcast") if wanted.count() <= BROADCAST_IDS else wanted
    texts = stored(lines.join(wanted, "id", "left_semi").select("id", "line"), "candidate-lines")
    # A line moves with each of its pairs; they are taken in parts, so that few of these copies are on disk at a time.
    moved, own = (df.agg(F.coalesce(F.sum(n), F.lit(0))).first()[0] for df, n in ((met, F.col("size")), (texts, F.length("line"))))
    parts = max(1, -(-moved // max(own, PAIR_CHARS)))
    found = []
    for part in range(parts):
        some = met.where(F.pmod(F.xxhash64("probe", "id"), F.lit(parts)) == part) if parts > 1 else met
        found.append(stored(_near(some.select("probe", "id"), texts, max_edits), "near-pairs"))
    return reduce(DataFrame.union, found)


def _near(met: DataFrame, texts: DataFrame, max_edits: int) -> DataFrame:
    """The candidate pairs (probe, id) that are near, as (a, b)."""
    pairs = (met.join(texts.select(F.col("id").alias("probe"), F.col("line").alias("a")), "probe")
             .join(texts.select("id", F.col("line").alias("b")), "id"))
    # Probes meet lines of their own or a smaller length; equal lengths meet from both sides, one is enough.
    pairs = pairs.where((F.length("a") > F.length("b")) | ((F.length("a") == F.length("b")) & (F.col("probe") < F.col("id"))))
    long = _differing(F.col("a"), F.col("b"), lambda a, b: F.call_function(
        "levenshtein", a, b, allowed_edits(F.length(F.col("a")), max_edits)) >= 0)
    near = F.when(F.length("a") < _long_from(max_edits), within_edits(F.col("a"), F.col("b"), max_edits)).otherwise(long)
    return pairs.where(near).select(F.col("probe").alias("a"), F.col("id").alias("b"))


def _before(doc: str, place: str, other_doc: str, other_place: str) -> Column:
    """Whether one first occurrence comes before another; a null document comes first."""
    d, o = (F.coalesce(F.col(c).cast("decimal(20,0)"), F.lit(Decimal(NO_ID)).cast("decimal(20,0)")) for c in (doc, other_doc))
    return (d < o) | ((d == o) & (F.col(place) < F.col(other_place)))


def _marked_lines(docs: DataFrame, max_edits: int, min_chars: int, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, place, h, dropped, near, class_id, n_links) of every line that is dropped or near another one; h: its MD5.

    class_id: document and place where the class's first line first comes; null without links. n_links: distinct lines near it.
    """
    lines = distinct_lines(docs, id_col, text_col)
    # A line of min_chars may be near an earlier one that is shorter by what its edits take away.
    pairs = near_pairs(lines, max_edits, min_chars, below=max_edits)
    firsts = lines.select("id", "first_doc", "first_place", F.length("line").alias("size"))
    both = (pairs.join(firsts.toDF("a", "a_doc", "a_place", "a_size"), "a").join(firsts.toDF("b", "b_doc", "b_place", "b_size"), "b"))
    a_first = _before("a_doc", "a_place", "b_doc", "b_place")
    links = both.withColumn("a_first", a_first).where(F.when(F.col("a_first"), F.col("b_size")).otherwise(F.col("a_size")) >= min_chars)
    links = stored(links.select(F.when(F.col("a_first"), F.col("a")).otherwise(F.col("b")).alias("u"),
                                F.when(F.col("a_first"), F.col("b")).otherwise(F.col("a")).alias("v")), "line-links")
    counts = (links.select(F.col("u").alias("id"), F.lit(False).alias("later"))
              .union(links.select(F.col("v").alias("id"), F.lit(True).alias("later")))
              .groupBy("id").agg(F.count("*").alias("n_links"), F.bool_or("later").alias("near")))
    members = components(links).join(firsts, F.col("node") == F.col("id")).select("node", "root", "first_doc", "first_place")
    heads = members.groupBy("root").agg(F.min(F.struct("first_doc", "first_place")).alias("head"))
    name = F.concat(F.coalesce(F.col("head.first_doc").cast("string"), F.lit("")), F.lit(":"), F.col("head.first_place").cast("string"))
    classes = members.join(heads, "root").select(F.col("node").alias("id"), name.alias("class_id")).join(counts, "id")
    # Lines meet their occurrences by a 128-bit hash; the texts themselves do not move again.
    known = (lines.select("id", F.unhex(F.md5("line")).alias("h"), "first_doc", "first_place").join(classes, "id", "left")
             .select("h", "first_doc", "first_place", F.coalesce("near", F.lit(False)).alias("near"),
                     "class_id", F.coalesce("n_links", F.lit(0)).alias("n_links")))
    found = _lines(docs, id_col, text_col).select("doc_id", "place", F.unhex(F.md5("line")).alias("h")).join(known, "h")
    first = F.col("doc_id").eqNullSafe(F.col("first_doc")) & (F.col("place") == F.col("first_place"))
    return found.where(F.col("near") | ~first | (F.col("n_links") > 0)).select(
        "doc_id", "place", "h", (F.col("near") | ~first).alias("dropped"), (F.col("near") & first).alias("near"), "class_id", "n_links")


def dropped_lines(docs: DataFrame, max_edits: int = MAX_EDITS, min_chars: int = MIN_CHARS, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """(doc_id, place, near) of every dropped line; near: it has no earlier equal, only an earlier near line."""
    return _marked_lines(docs, max_edits, min_chars, id_col, text_col).where("dropped").select("doc_id", "place", "near")


def line_report(docs: DataFrame, max_edits: int = MAX_EDITS, min_chars: int = MIN_CHARS, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """One row per doc_id: n_lines (not blank), n_dropped, n_near, the places of the dropped lines in order, and place, class_id
    and n_links of the lines that are in a class of near lines, in order."""
    drops = (_marked_lines(docs, max_edits, min_chars, id_col, text_col).groupBy("doc_id")
             .agg(F.count_if("dropped").alias("n_dropped"), F.count_if("near").alias("n_near"),
                  F.sort_array(F.collect_list(F.when(F.col("dropped"), F.col("place")))).alias("dropped_places"),
                  F.sort_array(F.collect_list(F.when(F.col("n_links") > 0, F.struct("place", "class_id", "n_links")))).alias("linked")))
    lines = F.size(F.filter(F.split(F.coalesce(F.col(text_col), F.lit("")), "\n"), lambda x: F.trim(x) != ""))
    sizes = (docs.select(F.col(id_col).cast("long").alias("doc_id"), lines.cast("long").alias("n"))
             .groupBy("doc_id").agg(F.sum("n").alias("n_lines")))
    return sizes.join(drops, sizes["doc_id"].eqNullSafe(drops["doc_id"]), "left").select(
        sizes["doc_id"], "n_lines", F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"),
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.coalesce("dropped_places", F.array().cast("array<int>")).alias("dropped_places"),
        F.coalesce("linked", F.array().cast("array<struct<place:int,class_id:string,n_links:bigint>>")).alias("linked_lines"))


def drop_repeated_lines(docs: DataFrame, max_edits: int = MAX_EDITS, min_chars: int = MIN_CHARS, id_col: str = "doc_id",
                        text_col: str = "text") -> DataFrame:
    """``docs`` with the dropped lines taken out of the text; its other columns are unchanged."""
    drops = (_marked_lines(docs, max_edits, min_chars, id_col, text_col).where("dropped")
             .groupBy("doc_id").agg(F.collect_set(F.struct("place", "h")).alias("drops")))
    # Both sides are renamed whole, as the table may have columns of any name.
    table = docs.toDF(*[f"c{k}" for k in range(len(docs.columns))])
    own_id, own_text = (table[f"c{docs.columns.index(c)}"] for c in (id_col, text_col))
    joined = table.join(drops, own_id.cast("long").eqNullSafe(drops["doc_id"]), "left")
    # By place and line: rows that share an id have other lines at the same places.
    kept = F.filter(F.split(own_text, "\n"), lambda x, k: ~F.array_contains(
        "drops", F.struct(k.cast("int").alias("place"), F.unhex(F.md5(x)).alias("h"))))
    text = F.when(F.size("drops") > 0, F.array_join(kept, "\n")).otherwise(own_text)
    return joined.select(*[(text if c == text_col else table[f"c{k}"]).alias(c) for k, c in enumerate(docs.columns)])
