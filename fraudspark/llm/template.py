"""Main text of pages by deducing each host's template from equivalence classes.

A token is a beginning or ending element, told apart by its path in the page and its number among
equal siblings. All pages of a host give, in one aggregate, each token's occurrence vector as a sum-like fingerprint (an exclusive or of
hashes of page and count, with support and total). Tokens of a host with equal vectors form a class;
classes of at least ``min_tokens`` tokens and enough support are candidates. A second pass over the
pages checks that a class's tokens always come in one order and that classes nest, and describes the
slot behind each token: how often it holds text, how much of it is links, whether it is the same on
all pages. Valid classes are the template. Extraction walks each page along its host's template; what
remains are the slots. A slot is left out if it lies in a page part that is not main text (by the
names on the token's path), or, outside of articles and main parts, if it is constant or mostly links.
Parts of a page that the template lacks (few pages have them) are judged by the names on their path.

No host's pages meet in one task: fingerprints and slots are summed before they are shuffled, and
templates go to the pages, by broadcast up to ``BROADCAST_TOKENS``, else by a join on host and a salt.
A host's template is bounded by its pages' own size: its tokens stand on a twentieth of the pages each.

Defined results: null html is empty and has no text; a null url makes one host of all such pages;
repeated rows are extracted each; pages of hosts with few pages are their own template; other columns
of the table are not looked at.
"""

from __future__ import annotations

import html as entities
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fraudspark.llm.markup import BREAK, DROPPED, LEVEL, LINK, SPACE, TEXT, TOKEN, signed, walk
from fraudspark.session import materialize

MIN_TOKENS = 3
MIN_PAGES = 3
MIN_SHARE = 0.05
BROKEN_SHARE = 0.1  # of its pages may break a class's order or nesting
LINK_SHARE = 0.5
CONSTANT_PAGES = 5
BROADCAST_TOKENS = 1_000_000
SALTS = 64
_MASK = (1 << 64) - 1
PAGE = 0  # as a token: the page itself


def host_of(url: Column) -> Column:
    """Host of an address in lower case, without user and port; empty if there is none."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.lower(found)


def _mixed(page: int, count: int) -> int:
    x = (page + count * 0x9E3779B97F4A7C15) & _MASK
    x = ((x ^ (x >> 32)) * 0xD6E8FEB86659FD93) & _MASK
    x = ((x ^ (x >> 29)) * 0xD6E8FEB86659FD93) & _MASK
    return signed(x ^ (x >> 32))


def token_vectors(pages: DataFrame) -> DataFrame:
    """Per host and token: support, total, vector (fingerprint), place (sum of first places), flags; token 0 counts pages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[tuple[str, int], list[int]] = {}
            for host, page, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                page &= _MASK
                seen: dict[int, list[int]] = {PAGE: [1, 0, 0]}
                for kind, token, flags in walk(text):
                    if kind == TOKEN:
                        if token in seen:
                            seen[token][0] += 1
                        else:
                            seen[token] = [1, len(seen), flags]
                for token, (count, place, flags) in seen.items():
                    one = found.get((host, token))
                    if one is None:
                        found[host, token] = [1, count, _mixed(page, count), place, flags]
                    else:
                        one[0] += 1
                        one[1] += count
                        one[2] ^= _mixed(page, count)
                        one[3] += place
            keys = list(found)
            columns = [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int64())]
            columns += [pa.array([v[i] for v in found.values()], pa.int64()) for i in range(5)]
            yield pa.RecordBatch.from_arrays(columns, ["host", "token", "support", "total", "vector", "place", "flags"])

    made = pages.select("host", "page", "html").mapInArrow(run, "host string, token long, support long, total long, vector long, place long, flags long")
    sums = [F.sum(c).alias(c) for c in ("support", "total", "place")]
    return made.groupBy("host", "token").agg(*sums, F.bit_xor("vector").alias("vector"), F.max("flags").alias("flags"))


def candidate_classes(vectors: DataFrame, min_tokens: int, min_pages: int, min_share: float) -> DataFrame:
    """Per host: pages, tokens, classes (number of each token's class), ranks (its place in the class), sizes (of its class)."""
    pages = vectors.where(F.col("token") == PAGE).select("host", F.col("support").alias("pages"))
    enough = F.least(F.col("pages"), F.greatest(F.lit(min_pages), F.ceil(F.col("pages") * min_share)))
    often = vectors.where(F.col("token") != PAGE).join(pages, "host").where(F.col("support") >= enough)
    token = F.struct((F.col("place") / F.col("support")).alias("place"), "token")
    grouped = often.groupBy("host", "pages", "support", "total", "vector").agg(F.sort_array(F.collect_list(token)).alias("members"))
    classes = grouped.where(F.size("members") >= min_tokens)
    of_host = classes.groupBy("host", "pages").agg(F.sort_array(F.collect_list(F.struct("support", F.col("members.token").alias("token")))).alias("found"))
    numbered = of_host.select("host", "pages", F.posexplode("found").alias("number", "one")).select(
        "host", "pages", "number", F.size("one.token").alias("size"), F.posexplode("one.token").alias("rank", "token")
    )
    lists = [F.collect_list(c).alias(n) for c, n in (("token", "tokens"), ("number", "classes"), ("rank", "ranks"), ("size", "sizes"))]
    return numbered.groupBy("host", "pages").agg(*lists)


def _with(pages: DataFrame, hosts: DataFrame, size: Column) -> DataFrame:
    """Pages with the columns of their host, if it has any: by broadcast if small, else by host and salt."""
    if (hosts.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0] + hosts.count()) <= BROADCAST_TOKENS:
        return pages.join(F.broadcast(hosts), "host", "left")
    salted = hosts.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    return pages.withColumn("salt", F.pmod("page", F.lit(SALTS))).join(salted, ["host", "salt"], "left").drop("salt")


def broken_classes(events: list, known: dict[int, tuple[int, int, int]]) -> tuple[set[int], set[int]]:
    """Classes that a page has, and those whose order or nesting it breaks.

    Where two classes cross, the one of less support (classes are numbered by support) does not nest.
    """
    seen: set[int] = set()
    broken: set[int] = set()
    inside: dict[int, int] = {}  # open classes, outermost first, and their next rank
    for kind, token, _ in events:
        if kind != TOKEN or token not in known:
            continue
        number, rank, size = known[token]
        seen.add(number)
        if rank == 0:
            if inside.pop(number, None) is not None:
                broken.add(number)
            inside[number] = 1
            continue
        if inside.get(number) != rank:
            broken.add(number)
            inside.pop(number, None)
            continue
        within = list(inside)
        crossing = within[within.index(number) + 1 :]
        if crossing and number < max(crossing):
            broken.add(number)
            del inside[number]
            continue
        for other in crossing:
            broken.add(other)
            del inside[other]
        inside[number] = rank + 1
        if rank == size - 1:
            del inside[number]
    return seen, broken | set(inside)


def _known(tokens: list, classes: list, ranks: list, sizes: list) -> dict[int, tuple[int, int, int]]:
    return {t: (c, r, s) for t, c, r, s in zip(tokens or (), classes or (), ranks or (), sizes or (), strict=True)}


def describe_slots(pages: DataFrame) -> DataFrame:
    """Per host and class: pages, broken; per host and slot (the token before it): pages, letters, linked, least and greatest text hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[tuple[str, int, int, int], list[int]] = {}
            for host, text, *lists in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
                events = walk(text)
                known = _known(*lists)
                seen, broken = broken_classes(events, known)
                for number in seen:
                    one = found.setdefault((host, 0, number, number), [0, 0, 0, 0, 0])
                    one[0] += 1
                    one[1] += number in broken
                slots: dict[int, list] = {}
                slot = PAGE
                for kind, value, flags in events:
                    if kind == TOKEN:
                        slot = value if value in known else slot
                    elif kind == TEXT and not value.isspace():
                        one = slots.setdefault(slot, [0, 0, []])
                        one[0] += len(value)
                        one[1] += len(value) if flags & LINK else 0
                        one[2].append(" ".join(value.split()))
                for slot, (letters, linked, texts) in slots.items():
                    text_hash = signed(xxhash.xxh64_intdigest("\n".join(texts)))
                    one = found.setdefault((host, 1, slot, known[slot][0] if slot in known else -1), [0, 0, 0, text_hash, text_hash])
                    one[0] += 1
                    one[1] += letters
                    one[2] += linked
                    one[3], one[4] = min(one[3], text_hash), max(one[4], text_hash)
            columns = [pa.array([k[0] for k in found], pa.string()), *(pa.array([k[i] for k in found], pa.int64()) for i in (1, 2, 3))]
            columns += [pa.array([v[i] for v in found.values()], pa.int64()) for i in range(5)]
            yield pa.RecordBatch.from_arrays(columns, ["host", "kind", "key", "number", "a", "b", "c", "low", "high"])

    made = pages.select("host", "html", "tokens", "classes", "ranks", "sizes").mapInArrow(
        run, "host string, kind long, key long, number long, a long, b long, c long, low long, high long"
    )
    sums = [F.sum(c).alias(c) for c in "abc"]
    return made.groupBy("host", "kind", "key", "number").agg(*sums, F.min("low").alias("low"), F.max("high").alias("high"))


def templates(classes: DataFrame, described: DataFrame, broken_share: float, link_share: float, constant_pages: int) -> DataFrame:
    """Per host: tokens of the valid classes, and the slots (by their token) that are constant or mostly links."""
    broken = described.where((F.col("kind") == 0) & (F.col("b") > F.col("a") * broken_share)).groupBy("host").agg(F.collect_list(F.col("key").cast("int")).alias("broken"))
    constant = (F.col("a") >= constant_pages) & (F.col("low") == F.col("high"))
    idle = described.where((F.col("kind") == 1) & (constant | (F.col("c") >= F.col("b") * link_share))).groupBy("host").agg(F.collect_list("key").alias("idle"))
    rows = classes.select("host", "tokens", "classes").join(broken, "host", "left").join(idle, "host", "full")
    pairs = F.arrays_zip("tokens", "classes")
    valid = F.filter(pairs, lambda p: ~F.array_contains(F.coalesce("broken", F.array().cast("array<int>")), p["classes"]))
    none = F.array().cast("array<long>")
    return rows.select("host", F.coalesce(F.transform(valid, lambda p: p["tokens"]), none).alias("tokens"), F.coalesce("idle", none).alias("idle"))


def main_text(events: list, tokens: set[int], idle: set[int]) -> str:
    """Blocks of the page's remaining slots."""
    kept: dict[int, list[str]] = {0: [], 1: [], 2: []}
    parts: dict[int, list[str]] = {0: [], 1: [], 2: []}
    slot, level_seen = PAGE, 0

    def flush() -> None:
        for level, some in parts.items():
            if some:
                block = " ".join(entities.unescape("".join(some)).split())
                if block:
                    kept[level].append(block)
                some.clear()

    for kind, value, flags in events:
        if kind == TOKEN or kind == BREAK:
            flush()
            if kind == TOKEN:
                slot = value if value in tokens else slot
                if not flags & DROPPED:
                    level_seen = max(level_seen, flags // LEVEL)
            continue
        level = flags // LEVEL
        if flags & DROPPED:
            continue
        if kind == SPACE:
            if parts[level]:
                parts[level].append(" ")
        elif level or slot not in idle:
            parts[level].append(value)
    flush()
    return "\n\n".join(kept[level_seen])


def extract(
    pages: DataFrame,
    id_column: str = "page_id",
    url_column: str = "url",
    html_column: str = "html",
    min_tokens: int = MIN_TOKENS,
    min_pages: int = MIN_PAGES,
    min_share: float = MIN_SHARE,
    broken_share: float = BROKEN_SHARE,
    link_share: float = LINK_SHARE,
    constant_pages: int = CONSTANT_PAGES,
) -> DataFrame:
    """Per page: page_id, url, text, n_chars, n_template (tokens of its host's template)."""
    url = F.col(url_column).cast("string")
    html = F.coalesce(F.col(html_column).cast("string"), F.lit(""))
    rows = pages.select(
        F.col(id_column).alias("page_id"), url.alias("url"), html.alias("html"), host_of(url).alias("host"),
        F.xxhash64(F.col(id_column), url, F.length(html)).alias("page"),
    )
    vectors = materialize(token_vectors(rows), "token_vectors")
    classes = materialize(candidate_classes(vectors, min_tokens, min_pages, min_share), "token_classes")
    candidates = _with(rows, classes.select("host", "tokens", "classes", "ranks", "sizes"), F.size("tokens"))
    described = materialize(describe_slots(candidates), "slots")
    found = materialize(templates(classes, described, broken_share, link_share, constant_pages), "templates")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, sizes = [], []
            for html, tokens, idle in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4)), strict=True):
                texts.append(main_text(walk(html), set(tokens or ()), set(idle or ())))
                sizes.append(len(tokens or ()))
            n = pa.array([len(t) for t in texts], pa.int64())
            columns = [batch.column(0), batch.column(1), pa.array(texts, pa.string()), n, pa.array(sizes, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars", "n_template"])

    kind = rows.schema["page_id"].dataType.simpleString()
    joined = _with(rows, found, F.size("tokens") + F.size("idle")).select("page_id", "url", "html", "tokens", "idle")
    return joined.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long, n_template long")
