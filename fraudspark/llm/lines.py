"""Line dedup by a segment-partition edit join, in DataFrame functions only.

A line goes if an earlier line (by id, text hash, line number) of any document is within a few edits.
Two lines of at least ``LONG_WORDS`` words are compared word by word, one edit for each ``words_per_edit``
words of the shorter; two shorter lines byte by byte, one edit for each ``chars_per_edit`` bytes; both up
to ``max_edits``. A word edit may change any number of bytes. Lines under ``chars_per_edit`` bytes are
layout and stay.

Equal lines are collapsed before keys are sent. Every distinct line is cut into threshold + 1 segments
(of bytes or words); two lines within the threshold share a segment at places that differ by few
symbols, so each line sends the hashes of its segments (the index) and of the runs that could be a
segment of an equally long or somewhat shorter line (the probes), keyed by that length and the
segment's number. Of a key's lines only the earliest is compared with all first; lines that fall to it
need no other. What remains is compared with the earlier lines of its keys. So that many lines that
share a segment, but are far apart, do not all meet, symbols are dealt into
2 max_edits + 1 groups: an edit changes two groups at most, so near lines have one group of equal symbols. Within keys
of more than ``HOT`` lines that is part of the join's key. A sketch of 64 parities, of which an edit flips
two at most, rules out nearly all pairs with more edits before a pair is made. Candidates are verified by the banded
bit-parallel edit distance on what is left between their common beginning and end.

The texts of candidate lines are found by a second scan, filtered by a bitmap of fixed size. The
texts themselves are shuffled once, to meet the numbers of their kept lines.

Lines, words, texts and segments are named by 64-bit hashes. Defined results: null texts stay null and empty
ones empty; rows that repeat id and text are one document and get equal results; a text without kept
lines becomes empty; input columns with the names of the report are replaced; all others stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fraudspark.llm.bitmap import maybe_in
from fraudspark.session import materialize

MAX_EDITS = 2
CHARS_PER_EDIT = 10
WORDS_PER_EDIT = 10
LONG_WORDS = 10
HOT = 32  # lines of a key that may all be compared
NUMBERS = 1 << 40  # of symbols; sums of eight million of them fit into 64 bits


def _bytes(line: Column) -> Column:
    """The line with one character for each byte."""
    return F.decode(F.encode(line, "UTF-8"), "ISO-8859-1")


def is_long(line: Column) -> Column:
    return F.length(line) - F.length(F.replace(line, F.lit(" "), F.lit(""))) >= LONG_WORDS - 1


def symbols(line: Column) -> Column:
    """The words of a long line, the bytes of another; ``line`` has a character for each byte."""
    return F.when(is_long(line), F.split(line, " ")).otherwise(F.split(line, ""))


def edits_allowed(length: Column, max_edits: int, symbols_per_edit: Column) -> Column:
    return F.least(F.floor(length / symbols_per_edit), F.lit(max_edits)).cast("int")


def _running_sums(start: Column, count: int, total: Column) -> Column:
    """The sums of all numbers before place ``start`` and the next ``count`` places, from the first of them."""
    onward = lambda sums, x: F.array_append(sums, F.element_at(sums, -1) + x)
    return F.aggregate(F.slice("named", start + 1, F.lit(count)), F.array(total), onward)


def segment_keys(rows: DataFrame, max_edits: int, reach: int) -> DataFrame:
    """Adds ``index``, keys of the line's segments, and ``probes``, keys of its possible segments of lines as long or shorter.

    A key names the sum of a segment's numbers: equal segments have equal keys, and verification tells
    those apart that only hold the same symbols. Segment i of t + 1 starts at p; in a line longer by d
    it can only start between max(p - i, p + d - (t - i)) and min(p + i, p + d + (t - i)), else the edits
    left and right of it are too many (i from 0). All these places lie near the line's own cuts, so the
    sums there come from one sum a cut. ``rows`` has ``named``, ``n``, and the edits ``t<d>`` of lines shorter by d.
    """
    n = F.col("n")

    def low(t: int, i: int) -> Column:
        """The first place near edge i of t + 1 segments."""
        if i in (0, t + 1):
            return n if i else F.lit(0)
        return F.greatest(F.expr(f"cast({i} * n div {t + 1} as int)") - reach, F.lit(0))

    fields = []
    for t in range(1, max_edits + 1):
        used = F.lit(False)
        for d in range(max_edits + 1):
            used = used | (F.col(f"t{d}") == t)
        for i in range(t + 1):
            part = F.slice("named", low(t, i) + 1, low(t, i + 1) - low(t, i))
            fields.append(F.when(used, F.aggregate(part, F.lit(0).cast("long"), lambda x, h: x + h)).alias(f"part{t}_{i}"))
    # a generator, so that the sums are taken once
    rows = rows.select("*", F.inline(F.array(F.struct(*fields))))
    upto = lambda t, i: sum((F.col(f"part{t}_{j}") for j in range(i)), F.lit(0).cast("long"))
    near = [
        F.when(F.col(f"part{t}_0").isNotNull(), _running_sums(low(t, i), 2 * reach, upto(t, i))).alias(f"near{t}_{i}")
        for t in range(1, max_edits + 1)
        for i in range(1, t + 1)
    ]
    whole = F.coalesce(*[upto(t, t + 1) for t in range(1, max_edits + 1)]).alias("s_all")
    rows = rows.select("*", F.inline(F.array(F.struct(*near, whole))))
    index, probes = [], []
    for d in range(max_edits + 1):
        for t in range(max(d, 1), max_edits + 1):
            edge = [F.expr(f"cast({i} * (n - {d}) div {t + 1} as int)") for i in range(t + 2)]

            def before(i: int, shift: int, t=t, edge=edge) -> Column:
                """The sum before the shifted edge i; the first is the line's begin, the last its end."""
                if i == 0:
                    return F.lit(0).cast("long")
                return F.col("s_all") if i == t + 1 else F.get(f"near{t}_{i}", edge[i] + shift - low(t, i))

            for i in range(t + 1):
                for shift in range(max(-i, d - (t - i)), min(i, d + (t - i)) + 1):
                    key = F.xxhash64("long", F.lit(i), n - d, before(i + 1, shift) - before(i, shift))
                    (index if d == 0 and shift == 0 else probes).append(F.when(F.col(f"t{d}") == t, key))
    return rows.withColumns({"index": F.array_compact(F.array(*index)), "probes": F.array_compact(F.array(*probes))})


def with_keys(lines: DataFrame, max_edits: int, chars_per_edit: int, words_per_edit: int) -> DataFrame:
    """The lines (of, no, lid) with the arrays ``index`` and ``probes`` of their keys, by words or by bytes."""
    split = lines.select("of", "no", "lid", "line", F.inline(F.array(F.struct(F.split("line", " ").alias("words")))))
    long = F.size("words") >= LONG_WORDS
    parts = F.when(long, F.col("words")).otherwise(F.split(_bytes(F.col("line")), ""))
    named = F.transform(parts, lambda w: F.xxhash64(w).bitwiseAND(F.lit(NUMBERS - 1)))
    facts = F.array(F.struct(named.alias("named"), long.alias("long")))
    rows = split.select("of", "no", "lid", F.inline(facts)).withColumn("n", F.size("named"))
    by = lambda words, chars: F.when(F.col("long"), words).otherwise(chars)
    short = {d: F.col("n") - d for d in range(max_edits + 1)}
    allowed = {
        f"t{d}": F.when(x >= by(LONG_WORDS, chars_per_edit), edits_allowed(x, max_edits, by(words_per_edit, chars_per_edit))).otherwise(0)
        for d, x in short.items()
    }
    # edges move by less than max_edits with the length, and by at most max_edits with the shift
    return segment_keys(rows.withColumns(allowed), max_edits, 2 * max_edits).select("of", "no", "lid", "index", "probes")


def group_marks(hashes: Column, groups: int) -> Column:
    """A mark of the symbols of each group: lines within t edits differ in the marks of at most 2 t groups."""
    own = lambda g: F.filter(hashes, lambda h: F.pmod(h, F.lit(groups)) == g)
    return F.array(*[F.aggregate(own(g), F.lit(0).cast("long"), lambda x, h: x.bitwiseXOR(h)) for g in range(groups)])


def parity_sketch(hashes: Column) -> Column:
    """A bit for each of 64 groups of symbols, set if their number is odd: t edits flip at most 2 t bits."""
    bit = lambda h: F.call_function("shiftleft", F.lit(1).cast("long"), h.bitwiseAND(F.lit(63)).cast("int"))
    return F.aggregate(hashes, F.lit(0).cast("long"), lambda x, h: x.bitwiseXOR(bit(h)))


def _alike(x: str, y: str, max_edits: int) -> Column:
    """Whether the lines named x and y may be within the edits, by their sketches and marks."""
    marks = [F.get(f"{x}.marks", g) == F.get(f"{y}.marks", g) for g in range(2 * max_edits + 1)]
    same = sum((one.cast("int") for one in marks), F.lit(0))
    flipped = F.bit_count(F.col(f"{x}.sketch").bitwiseXOR(F.col(f"{y}.sketch")))
    return (flipped <= 2 * max_edits) & (same >= 1)


def _common(a: Column, b: Column, most: Column) -> Column:
    """Length of the common beginning of two arrays, at most ``most``."""
    other = F.array_position(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)), F.lit(False)).cast("int")
    return F.least(F.when(other == 0, F.size(a)).otherwise(other - 1), most)


def edit_distance(pairs: DataFrame, max_edits: int) -> DataFrame:
    """Adds ``edits``: the edit distance of the arrays x (not longer) and y if at most max_edits, else more.

    A bit-parallel band of 2 max_edits + 1 rows moves along the diagonal, one column for each symbol of
    y; bit k of a column's vectors stands for row column - max_edits + k. Common ends are cut off before,
    as far as x keeps more than max_edits symbols.
    """
    width = 2 * max_edits + 1
    full = (1 << width) - 1
    spare = F.greatest(F.size("x") - max_edits - 1, F.lit(0))
    pairs = pairs.withColumn("head", _common(F.col("x"), F.col("y"), spare))
    pairs = pairs.withColumn("tail", _common(F.reverse("x"), F.reverse("y"), spare - F.col("head")))
    cut = lambda c: F.slice(c, F.col("head") + 1, F.size(c) - F.col("head") - F.col("tail"))
    pairs = pairs.withColumn("pa", cut(F.col("x"))).withColumn("qa", cut(F.col("y")))
    pairs = pairs.withColumn("m", F.size("pa")).withColumn("n", F.size("qa"))

    def step(s: Column, i: Column) -> Column:
        letter = F.get("qa", i)
        match = F.lit(0)
        for k in range(width):
            row = i - max_edits + k
            same = (row >= 0) & (row < F.col("m")) & (F.get("pa", row) == letter)
            match = match + F.when(same, 1 << k).otherwise(0)
        return F.transform(F.array(F.struct(s["vp"].alias("vp"), s["vn"].alias("vn"), s["d"].alias("d"), match.alias("x"))), lambda z: _column(z, i))[0]

    def _column(z: Column, i: Column) -> Column:
        no = lambda c: c.bitwiseXOR(F.lit(full))
        d0 = ((z["x"].bitwiseAND(z["vp"]) + z["vp"]).bitwiseAND(F.lit(full)).bitwiseXOR(z["vp"])).bitwiseOR(z["x"]).bitwiseOR(z["vn"])
        return F.transform(F.array(F.struct(d0.alias("d0"), z.alias("z"))), lambda w: _after(w["d0"], w["z"], i, no))[0]

    def _after(d0: Column, z: Column, i: Column, no) -> Column:
        hp = z["vn"].bitwiseOR(no(d0.bitwiseOR(z["vp"])))
        hn = d0.bitwiseAND(z["vp"])
        down = F.shiftright(d0, 1)
        steep = i < F.col("m") - max_edits
        bit = F.lit(width - 2) - (i - (F.col("m") - max_edits))
        set_at = lambda c: F.when(bit >= 0, F.call_function("shiftright", c, bit).bitwiseAND(F.lit(1))).otherwise(0)
        diagonal = F.when(F.shiftright(d0, width - 1).bitwiseAND(F.lit(1)) == 1, 0).otherwise(1)
        more = F.when(steep, diagonal).otherwise(set_at(hp) - set_at(hn))
        return F.struct(
            hn.bitwiseOR(no(down.bitwiseOR(hp))).alias("vp"),
            down.bitwiseAND(hp).alias("vn"),
            (z["d"] + more).alias("d"),
        )

    start = F.struct(
        F.lit((full << (width - max_edits - 1)) & full).alias("vp"), F.lit(0).alias("vn"), F.lit(max_edits).alias("d")
    )
    walked = F.aggregate(F.sequence(F.lit(0), F.col("n") - 1), start, step)["d"]
    hopeless = F.col("n") - F.col("m") > max_edits
    if max_edits == 2:
        # both ends of what is left take an edit each, so all between them stands in y as it is
        inner = lambda c, at: F.slice(c, F.lit(at), F.col("m") - 2)
        whole = (inner("pa", 2) == inner("qa", 1)) | (inner("pa", 2) == inner("qa", 2)) | (inner("pa", 2) == inner("qa", 3))
        hopeless = hopeless | F.when(F.col("m") > max_edits + 1, ~whole).otherwise(F.lit(False))
    edits = F.when(hopeless, F.lit(max_edits + 1)).otherwise(walked)
    return pairs.withColumn("edits", edits).drop("head", "tail", "m", "n", "pa", "qa")


def _lines(docs: DataFrame, id_column: str, text_column: str, least: int) -> DataFrame:
    """(pos, no, line, lid) of all lines long enough; pos orders the documents."""
    text = F.col(text_column).cast("string")
    rows = docs.where(text.isNotNull()).select(
        F.struct(F.col(id_column).alias("id"), F.xxhash64(text).alias("text")).alias("of"),
        F.posexplode(F.split(text, "\n")).alias("no", "line"),
    )
    return rows.where(F.octet_length("line") >= least).select("of", "no", "line", F.xxhash64("line").alias("lid"))


def _near(pairs: DataFrame, texts: DataFrame, max_edits: int, chars_per_edit: int, words_per_edit: int) -> DataFrame:
    """The pairs (early, late) of line ids within the allowed edits."""
    of = lambda name, column: texts.select(F.col("lid").alias(name), F.col("line").alias(column))
    rows = pairs.join(of("early", "a"), "early").join(of("late", "b"), "late")
    rows = rows.select("early", "late", is_long(F.col("a")).alias("long"), symbols(F.col("a")).alias("a"), symbols(F.col("b")).alias("b"))
    first = F.size("a") <= F.size("b")
    rows = rows.select("early", "late", "long", F.when(first, F.col("a")).otherwise(F.col("b")).alias("x"), F.when(first, F.col("b")).otherwise(F.col("a")).alias("y"))
    rows = edit_distance(rows, max_edits).select("early", "late", "long", F.size("x").alias("size"), "edits")
    # written before the filter, which would else be pushed below and repeat the walk for every use of a column
    rows = materialize(rows, "line_edits")
    per_edit = F.when(F.col("long"), words_per_edit).otherwise(chars_per_edit)
    return rows.where(F.col("edits") <= edits_allowed(F.col("size"), max_edits, per_edit)).select("early", "late")


def _remaining_pairs(still: DataFrame, matched: DataFrame, max_edits: int) -> DataFrame:
    """Pairs (early, late) of lines still there with earlier lines of their keys that may be near."""
    crowd = matched.groupBy("key").count().where(F.col("count") > HOT).select("key")
    crowd = materialize(crowd, "hot_keys")
    late, early = still.alias("x"), matched.alias("y")
    fits = (F.col("x.indexed") | F.col("y.indexed")) & (F.col("y.pos") < F.col("x.pos")) & (F.col("x.lid") != F.col("y.lid"))
    alike = _alike("x", "y", max_edits)
    pair = [F.col("y.lid").alias("early"), F.col("x.lid").alias("late")]
    plain = late.join(crowd, "key", "left_anti").alias("x").join(early, F.col("x.key") == F.col("y.key")).where(fits & alike).select(*pair)

    # lines of a hot key meet only where a group has equal symbols
    shared = lambda rows: (
        rows.join(crowd, "key", "left_semi").select("*", F.posexplode("marks").alias("group", "one"))
        .withColumn("mark", F.xxhash64("key", "group", "one")).drop("one")
    )
    x, y = shared(still).alias("x"), shared(matched).alias("y")
    equal = F.array(*[F.get("x.marks", g) == F.get("y.marks", g) for g in range(2 * max_edits + 1)])
    # by the first of its equal groups only
    once = (F.col("x.key") == F.col("y.key")) & (F.array_position(equal, True) == F.col("x.group") + 1)
    hot = x.join(y, F.col("x.mark") == F.col("y.mark")).where(fits & once & alike).select(*pair)
    return plain.unionByName(hot).distinct()


def dedup_lines(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    max_edits: int = MAX_EDITS,
    chars_per_edit: int = CHARS_PER_EDIT,
    words_per_edit: int = WORDS_PER_EDIT,
) -> DataFrame:
    """The documents with their kept lines as text, and n_lines and n_dropped."""
    lines = _lines(docs, id_column, text_column, chars_per_edit)
    described = with_keys(lines, max_edits, chars_per_edit, words_per_edit)
    distinct = described.groupBy("lid").agg(
        F.min(F.struct("of", "no")).alias("pos"), F.first("index").alias("index"), F.first("probes").alias("probes")
    )
    distinct = materialize(distinct, "distinct_lines")

    own = distinct.select("lid", F.explode("index").alias("key"), F.lit(True).alias("indexed"))
    sent = own.unionByName(distinct.select("lid", F.explode("probes").alias("key"), F.lit(False).alias("indexed")))
    index = own.groupBy("key").agg(F.count("*").alias("n"), F.min("lid").alias("some"))
    met = sent.join(index, "key").where((F.col("n") > 1) | (F.col("some") != F.col("lid")))
    met = materialize(met, "met_keys")
    alone = met.where(F.col("n") == 1).select("key", F.col("some").alias("lid"), F.lit(True).alias("indexed"))
    matched = met.select("key", "lid", "indexed").unionByName(alone)
    # distinct rows, as a line may meet a key twice
    matched = materialize(matched.groupBy("key", "lid").agg(F.max("indexed").alias("indexed")), "matched_keys")

    wanted = materialize(matched.select("lid").distinct(), "candidate_lines")
    seen = maybe_in(lines, "lid", wanted, "lid").groupBy("lid").agg(F.first("line").alias("line"))
    texts = seen.join(wanted, "lid").select("lid", _bytes(F.col("line")).alias("line"))
    hashes = F.transform(symbols(F.col("line")), lambda w: F.xxhash64(w)).alias("hashes")
    texts = texts.select("*", F.inline(F.array(F.struct(hashes))))  # a generator, so that symbols are hashed once
    signs = {"marks": group_marks(F.col("hashes"), 2 * max_edits + 1), "sketch": parity_sketch(F.col("hashes"))}
    texts = materialize(texts.withColumns(signs).drop("hashes"), "candidate_texts")
    places = distinct.select("lid", "pos").join(texts.select("lid", "marks", "sketch"), "lid")
    matched = materialize(matched.join(places, "lid"), "matched_lines")

    earliest = matched.where("indexed").groupBy("key").agg(F.min(F.struct("pos", "lid", "marks", "sketch")).alias("e"))
    against = matched.alias("x").join(earliest, "key").where((F.col("lid") != F.col("e.lid")) & _alike("x", "e", max_edits))
    swap = F.col("e.pos") < F.col("pos")
    first = against.select(
        F.when(swap, F.col("e.lid")).otherwise(F.col("lid")).alias("early"),
        F.when(swap, F.col("lid")).otherwise(F.col("e.lid")).alias("late"),
    ).distinct()
    first = materialize(first, "line_pairs")
    near = _near(first, texts, max_edits, chars_per_edit, words_per_edit)
    gone = near.select(F.col("late").alias("lid")).distinct()
    # lines that are still there against all earlier lines of their keys, as probes and as indexed ones
    still = matched.join(gone, "lid", "left_anti").join(earliest, "key").where(F.col("lid") != F.col("e.lid")).drop("e")
    rest = materialize(_remaining_pairs(still, matched, max_edits).join(first, ["early", "late"], "left_anti"), "line_pairs")
    more = _near(rest, texts, max_edits, chars_per_edit, words_per_edit)
    gone = gone.unionByName(more.select(F.col("late").alias("lid"))).distinct()

    kept = (
        distinct.select("lid", "pos").join(gone, "lid", "left_anti")
        .groupBy(F.col("pos.of.id").alias("__id"), F.col("pos.of.text").alias("__text"))
        .agg(F.collect_list("pos.no").alias("__kept"))
    )
    text = F.col(text_column).cast("string")
    same = docs[id_column].eqNullSafe(F.col("__id")) & (F.xxhash64(text) == F.col("__text"))
    whole = docs.join(kept, same, "left")
    numbers = F.sort_array(F.array_union(F.coalesce("__kept", F.array().cast("array<int>")), _short_lines(F.col("__lines"), chars_per_edit)))
    report = F.struct(
        F.when(text.isNotNull(), F.array_join(F.transform(numbers, lambda i: F.get("__lines", i)), "\n")).alias("__new"),
        F.coalesce(F.size("__lines"), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("__lines") - F.size(numbers), F.lit(0)).cast("long").alias("n_dropped"),
    )
    # a generator, below which no later filter is pushed: it would split the text anew for every line
    own = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    whole = whole.withColumn("__lines", F.split(text, "\n")).select(*own, F.inline(F.array(report)))
    return whole.withColumn(text_column, F.col("__new")).drop("__new")


def _short_lines(lines: Column, least: int) -> Column:
    """Numbers of the lines that are layout."""
    numbered = F.transform(lines, lambda line, i: F.when(F.octet_length(line) < least, i))
    return F.array_compact(F.coalesce(numbered, F.array().cast("array<int>")))


def _oracle() -> str:
    """SQL of the same rule: word edits by a band of five cells a column, folded over the words of the longer line."""
    cell = {}
    for k in range(1, 6):
        o = k - 3
        up = f"s[{k + 1}] + 1" if k < 5 else "99"
        cell[k] = (
            f"(CASE WHEN e[1] + {o} = 0 THEN e[1] WHEN e[1] + {o} < 0 OR e[1] + {o} > len(p.x) THEN 99 "
            f"ELSE least(s[{k}] + CAST(p.x[e[1] + {o}] <> p.y[e[1]] AS INT), {up}) END)"
        )
    after = ", ".join("least(" + ", ".join(f"{cell[i]} + {k - i}" for i in range(1, k + 1)) + ")" for k in range(1, 6))
    return rf"""
WITH l AS (
  SELECT doc_id, unnest(range(1, len(ls) + 1)) AS no, unnest(ls) AS line
  FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL)),
f AS (
  SELECT line, min(doc_id * 100000000 + no) AS pos, strlen(line) AS n, string_split(line, ' ') AS w, len(string_split(line, ' ')) AS nw
  FROM l WHERE strlen(line) >= 10 GROUP BY line),
near_bytes AS (
  SELECT DISTINCT b.line FROM f b, (SELECT unnest([-2, -1, 0, 1, 2]) AS d) s, f a
  WHERE a.n = b.n + s.d AND a.pos < b.pos AND a.nw < 10 AND b.nw < 10
    AND (contains(b.line, a.line[:length(a.line) // 3])  -- two edits leave one third of the line as it is
         OR contains(b.line, a.line[length(a.line) // 3 + 1:2 * length(a.line) // 3])
         OR contains(b.line, a.line[2 * length(a.line) // 3 + 1:]))
    AND levenshtein(a.line, b.line) <= least(2, least(a.n, b.n) // 10)),
word_pairs AS (
  SELECT b.line, CASE WHEN a.nw <= b.nw THEN a.w ELSE b.w END AS x, CASE WHEN a.nw <= b.nw THEN b.w ELSE a.w END AS y
  FROM f b, (SELECT unnest([-2, -1, 0, 1, 2]) AS d) s, f a
  WHERE a.nw = b.nw + s.d AND a.pos < b.pos AND a.nw >= 10 AND b.nw >= 10
    AND (contains(' ' || b.line || ' ', ' ' || array_to_string(a.w[1:a.nw // 3], ' ') || ' ')
         OR contains(' ' || b.line || ' ', ' ' || array_to_string(a.w[a.nw // 3 + 1:2 * (a.nw // 3)], ' ') || ' ')
         OR contains(' ' || b.line || ' ', ' ' || array_to_string(a.w[2 * (a.nw // 3) + 1:], ' ') || ' '))),
walked AS (
  SELECT line, len(x) AS m, len(y) AS n,
    list_reduce(list_prepend([99, 99, 0, 1, 2], list_transform(range(1, len(y) + 1), lambda j: [CAST(j AS INT)])), lambda s, e: [{after}]) AS band
  FROM word_pairs p),
near AS (SELECT line FROM near_bytes UNION SELECT line FROM walked WHERE band[m - n + 3] <= least(2, m // 10)),
k AS (
  SELECT l.doc_id, l.no, l.line FROM l LEFT JOIN f ON l.line = f.line
  WHERE strlen(l.line) < 10 OR (f.pos = l.doc_id * 100000000 + l.no AND l.line NOT IN (SELECT line FROM near))),
r AS (SELECT doc_id, count(*) AS n, string_agg(line, chr(10) ORDER BY no) AS t FROM k GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n FROM l GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(t.n, 0) AS BIGINT) AS n_lines, CAST(coalesce(t.n, 0) - coalesce(r.n, 0) AS BIGINT) AS n_dropped,
       md5(coalesce(r.t, '')) AS kept_md5
FROM documents d LEFT JOIN t USING (doc_id) LEFT JOIN r USING (doc_id)
"""


ORACLE = _oracle()
