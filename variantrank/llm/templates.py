"""Benchmark decontamination by template canonicalisation.

Numbers, names and units become typed placeholders, so a question whose figures or names were exchanged keeps its
template. Windows of template words are hash-joined with those of the benchmark, by the hash of some literal words that
the window holds, and confirmed on all words; the values in the slots must map one to one from the item to the document
along the same alignment.

Defined results: null or empty texts hold no window; documents are told apart by id, so rows with the same id count as
one document; benchmark items with the same words are one item under their smallest id; items under MIN_WORDS words are
searched for as they stand only, those under MIN_RUN not at all, as they prove nothing; empty tables give an empty result; other columns are ignored. Rows with a null
id take part under the null id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from variantrank.llm.common import GAP, let, write_stage

NAME, NUMBER, UNIT = "\ue000", "\ue001", "\ue002"
MARKS = r"[\p{P}\p{S}]++"
UNITS = "km|cm|mm|m|kg|mg|g|lb|oz|mi|ft|ms|s|min|h|ml|l|usd|eur|gbp|percent|kwh|kw|mph|kmh|gb|mb|kb"
WINDOW, MIN_WORDS, MIN_LITERALS, LEAK_FROM = 8, 5, 3, 0.5
#: Consecutive words that prove a leak as they stand, or the whole item if shorter, which must have MIN_RUN words.
RUN, MIN_RUN = 13, 3
#: The two kinds of templates, and whether every capitalised word is a name in them.
KINDS = {"named": False, "capital": True}
#: Places, from the first on, of the words of an anchor, by preference.
SHAPES = ((0, 1, 2, 3), (0, 1, 2), (0, 1), (0, 2), (0, 3))
#: Windows of the benchmark that are broadcast at most: 1 million rows of a hash, a key and two short word lists.
MOST_BROADCAST = 1_000_000


def canonical(text: Column, every: bool = False) -> Column:
    """The text with placeholders, in lower case and without punctuation; it keeps its words' places.

    A name is a capitalised word that follows a lower-case letter, a comma or a semicolon and one space; with every, each
    capitalised word, also where it begins a text, line or sentence or follows a figure or mark.
    """
    named = F.regexp_replace(text, r"(?<!\p{L})\p{Lu}\p{Ll}+" if every else r"\p{Lu}(?<=[\p{Ll},;] \p{Lu})\p{Ll}+", NAME)
    numbered = F.regexp_replace(F.lower(named), r"\p{N}++(?:[.,:/]\p{N}+)*", NUMBER)
    measured = F.regexp_replace(numbered, rf"({NUMBER} ?)(?:{UNITS})(?!\p{{L}})", f"$1{UNIT}")
    return F.regexp_replace(measured, MARKS, "")


def _words(text: Column) -> Column:
    return F.array_remove(F.split(text, GAP), "")


def _split(df: DataFrame, key: str, text_col: str, out: str, *more: Column) -> DataFrame:
    """The key, the words without punctuation (said), in lower case (plain), and their template words by both kinds of
    names, all place by place."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return df.select(
        F.col(key).alias(out), _words(F.regexp_replace(text, MARKS, "")).alias("said"), plain_words(text).alias("plain"),
        *[_words(canonical(text, every)).alias(kind) for kind, every in KINDS.items()], *more,
    )


def plain_words(text: Column) -> Column:
    """Lower-case words without punctuation; a template word without placeholder is the plain word of its place."""
    return _words(F.regexp_replace(F.lower(text), MARKS, ""))


def _windows(template: Column, size: int) -> Column:
    """Hashes of all windows of size words, by start; empty where there are fewer words."""
    hashes = F.transform(template, lambda w: F.xxhash64(w))
    starts = lambda h: F.sequence(F.lit(0), F.size(h) - size)
    return F.when(
        F.size(template) >= size,
        let(hashes, lambda h: F.transform(starts(h), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(size)]))),
    ).otherwise(F.array().cast("array<bigint>"))


def _all_windows(template: Column, sizes: list[int]) -> Column:
    """(hash, at, n) of the windows of all these sizes."""

    def of(size: int) -> Column:
        return F.transform(_windows(template, size), lambda h, i: F.struct(h.alias("hash"), i.alias("at"), F.lit(size).alias("n")))

    return F.concat(*[of(size) for size in sorted(sizes) or [WINDOW]])


def _cut(items: DataFrame, size: Column, **columns: str) -> DataFrame:
    """(item, form, words, item_at, size, ...) of all windows of `size` words of the items, with slices of the named columns.

    form tells texts with the same item id apart, words is their number of words."""
    starts = items.withColumn("size", size).withColumn("item_at", F.explode(F.sequence(F.lit(0), F.size("plain") - F.col("size"))))
    parts = [F.slice(c, F.col("item_at") + 1, F.col("size")).alias(n) for n, c in columns.items()]
    return starts.select("item", F.xxhash64(*columns.values()).alias("form"), F.size("plain").alias("words"), "item_at", "size", *parts)


def benchmark_windows(items: DataFrame, kind: str) -> DataFrame:
    """Windows of the items (as _split gives them) by one kind of template: item, form, item_at, size, item_said,
    item_template, item_plain, item_windows."""
    once = items.where(F.size("said") >= MIN_WORDS).groupBy("said", kind).agg(F.min("item").alias("item"), F.first("plain").alias("plain"))
    cut = _cut(once, F.least(F.size(kind), F.lit(WINDOW)), item_said="said", item_template=kind, item_plain="plain")
    literal = F.filter("item_template", lambda w: ~w.isin(NAME, NUMBER, UNIT, ""))
    kept = cut.where(F.size(literal) >= MIN_LITERALS)
    return kept.withColumn("item_windows", F.count("*").over(Window.partitionBy("item"))).drop("words")


def benchmark_runs(items: DataFrame) -> DataFrame:
    """Runs of RUN words of the items, or all words of a shorter one: item, form, words (of the item), item_at, size, item_plain."""
    once = items.where(F.size("plain") >= MIN_RUN).groupBy("plain").agg(F.min("item").alias("item"))
    return _cut(once, F.least(F.size("plain"), F.lit(RUN)), item_plain="plain")


def anchors(windows: DataFrame) -> DataFrame:
    """(kind, item, form, item_at, p, shape, key): some words of every window of (kind, item, form, item_at, size, template, plain).

    Only words without placeholder count, which a document that holds the window must have in the same places. Of a
    window's choices that of the first shape is taken, then the rarest of the benchmark, then the longest.
    """
    word = lambda i: F.get("plain", F.lit(i))

    def choice(shape: int, i: int) -> Column:
        places = [i + x for x in SHAPES[shape]]
        fits = F.col("size") > places[-1]
        for x in places:
            fits &= F.get("template", F.lit(x)) == word(x)
        letters = sum((F.length(word(x)) for x in places[1:]), F.length(word(i)))
        key = F.xxhash64(F.lit(shape), *map(word, places))
        return F.when(fits, F.struct(F.lit(shape).alias("shape"), (F.col("item_at") + i).alias("p"), key.alias("key"), letters.alias("letters")))

    choices = F.array_compact(F.array(*[choice(s, i) for s, x in enumerate(SHAPES) for i in range(RUN - x[-1])]))
    each = write_stage(windows.select("kind", "item", "form", "item_at", F.inline(choices)), "benchmark-choices")
    often = each.select("item", "form", "p", "key").distinct().groupBy("key").agg(F.count("*").alias("often"))
    best = F.min_by(F.struct("p", "shape", "key"), F.struct("shape", "often", -F.col("letters"), "p")).alias("best")
    return each.join(often, "key").groupBy("kind", "item", "form", "item_at").agg(best).select("kind", "item", "form", "item_at", "best.*")


def _hash_of(template: str) -> Column:
    """The hash that _windows gives a window with these words, for every size from MIN_WORDS to WINDOW."""
    out = F.lit(None).cast("bigint")
    for size in range(MIN_WORDS, WINDOW + 1):
        out = F.when(F.size(template) == size, F.xxhash64(*[F.xxhash64(F.get(template, F.lit(k))) for k in range(size)])).otherwise(out)
    return out


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Pairs of a document and an item of which it holds at least LEAK_FROM of the windows, with consistent slots.

    (id_col, item_col, n_windows, item_windows, n_slots, changed_slots, first_word). Both are compared twice: with names as told
    by what precedes them, and with every capitalised word as a name, so that names at the beginning of sentences may
    differ too. A pair is reported as the first comparison finds it, else the second. Pairs known only from a run of the same
    words follow, with no windows and no slots.

    One pass over the documents looks up a few words that every window of the benchmark was chosen some of (anchors). Where
    these stand, the item's windows can stand only along one alignment; templates are made of such documents alone, and
    of them the words along the alignment are compared with all windows of the item.
    """
    items = write_stage(_split(benchmark, item_col, item_text_col, "item"), "benchmark-items")
    known = {kind: write_stage(benchmark_windows(items, kind), f"benchmark-{kind}") for kind in KINDS}
    runs = write_stage(benchmark_runs(items), "benchmark-runs")
    beside = write_stage(_overlaps(docs, _alignments(docs, items, known, runs, id_col, text_col), items, id_col, text_col), "overlaps")
    same = F.col("doc").eqNullSafe(F.col("_doc")) & F.col("item").eqNullSafe(F.col("_item"))

    def others(more: DataFrame, before: DataFrame) -> DataFrame:
        return more.join(before.select(F.col("doc").alias("_doc"), F.col("item").alias("_item")), same, "left_anti")

    found = None
    for kind in KINDS:
        held = _held(beside, known[kind], kind)
        found = write_stage(held if found is None else found.union(others(held, found)), "leaks")
    return found.union(others(_runs(beside, runs), found)).withColumnsRenamed({"doc": id_col, "item": item_col})


def _alignments(docs: DataFrame, items: DataFrame, known: dict[str, DataFrame], runs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc, item, shift): where an item's word 0 would stand in the document if the anchor found there belongs to it.

    Nothing of a document is shuffled but these, counted where they are made. Anchors beyond MOST_BROADCAST rows meet the
    documents' words by a shuffle instead. Windows without two plain words near each other are looked up as a whole.
    """
    parts = [w.select(F.lit(kind).alias("kind"), "item", "form", "item_at", "size", F.col("item_template").alias("template"), F.col("item_plain").alias("plain")) for kind, w in known.items()]
    parts.append(runs.select(F.lit("run").alias("kind"), "item", "form", "item_at", "size", F.col("item_plain").alias("template"), F.col("item_plain").alias("plain")))
    windows = parts[0].union(parts[1]).union(parts[2])
    chosen = write_stage(anchors(windows), "anchors")
    known_keys = write_stage(chosen.select("item", "p", "shape", "key").distinct(), "anchor-keys")
    shapes = sorted(r["shape"] for r in known_keys.select("shape").distinct().collect()) or [0]
    words = docs.select(F.col(id_col).alias("doc"), plain_words(F.coalesce(F.col(text_col), F.lit(""))).alias("plain"))
    placed = words.select("doc", "plain", F.posexplode("plain").alias("i", "word"))
    after = lambda x: F.get("plain", F.col("i") + x)
    keys = [F.xxhash64(F.lit(shape), F.col("word"), *map(after, SHAPES[shape][1:])) for shape in shapes]
    keyed = placed.select("doc", "i", (F.explode(F.array(*keys)) if len(keys) > 1 else keys[0]).alias("key"))
    wanted = known_keys.select("item", "p", "key")
    wanted = F.broadcast(wanted) if wanted.count() <= MOST_BROADCAST else wanted
    shift = (F.col("i") - F.col("p")).alias("shift")
    met = keyed.join(wanted, "key").select("doc", "item", shift)
    for kind, w in known.items():
        without = chosen.where(F.col("kind") == kind).select(F.col("item").alias("_item"), F.col("form").alias("_form"), F.col("item_at").alias("_at"))
        same = F.col("item").eqNullSafe(F.col("_item")) & (F.col("form") == F.col("_form")) & (F.col("item_at") == F.col("_at"))
        loose = w.join(without, same, "left_anti")
        loose = write_stage(loose.select("item", "item_at", "size", _hash_of("item_template").alias("hash")), f"loose-{kind}")
        if not loose.isEmpty():
            met = met.union(_whole_windows(docs, loose, kind, id_col, text_col))
    return write_stage(met.distinct(), "alignments")


def _whole_windows(docs: DataFrame, loose: DataFrame, kind: str, id_col: str, text_col: str) -> DataFrame:
    """(doc, item, shift) of windows without anchor, by the hash of the whole window."""
    sizes = [r["size"] for r in loose.select("size").distinct().collect()]
    template = _words(canonical(F.coalesce(F.col(text_col), F.lit("")), KINDS[kind]))
    windows = docs.select(F.col(id_col).alias("doc"), F.explode(_all_windows(template, sizes)).alias("w")).select("doc", "w.hash", "w.at")
    wanted = loose.select("item", "item_at", "hash")
    wanted = F.broadcast(wanted) if wanted.count() <= MOST_BROADCAST else wanted
    return windows.join(wanted, "hash").select("doc", "item", (F.col("at") - F.col("item_at")).alias("shift"))


def _overlaps(docs: DataFrame, alignments: DataFrame, items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc, item, shift, lo, and the words and template words from place lo on as far as the item reaches)."""
    long = items.groupBy("item").agg(F.max(F.size("plain")).alias("long")).withColumnRenamed("item", "_item")
    lines = alignments.join(F.broadcast(long) if long.count() <= MOST_BROADCAST else long, F.col("item").eqNullSafe(F.col("_item")))
    # One row per document, so that its templates are made once and not for each of its lines.
    lines = lines.groupBy(F.col("doc").alias("_doc")).agg(F.collect_list(F.struct("item", "shift", "long")).alias("lines"))
    lines = write_stage(lines, "aligned")
    lines = F.broadcast(lines) if alignments.count() <= MOST_BROADCAST else lines
    near = docs.select(F.col(id_col).alias(id_col), F.col(text_col).alias(text_col)).join(lines, F.col(id_col).eqNullSafe(F.col("_doc")))
    texts = _split(near, id_col, text_col, "doc", F.col("lines"))
    columns = ("said", "plain", *KINDS)

    def along(line: Column) -> Column:
        lo = F.greatest(line["shift"], F.lit(0))
        reach = F.greatest(F.least(F.size("plain"), line["shift"] + line["long"]) - lo, F.lit(0))
        return F.struct(line["item"].alias("item"), line["shift"].alias("shift"), lo.alias("lo"), *[F.slice(c, lo + 1, reach).alias(c) for c in columns])

    return texts.select("doc", F.inline(F.transform("lines", along)))


def _along(beside: DataFrame, windows: DataFrame) -> DataFrame:
    """Every overlap with every window of its item that lies in it; at is the window's place in the document."""
    item = windows.withColumnRenamed("item", "_item")
    item = F.broadcast(item) if windows.count() <= MOST_BROADCAST else item
    met = beside.join(item, F.col("item").eqNullSafe(F.col("_item"))).withColumn("at", F.col("shift") + F.col("item_at"))
    return met.where((F.col("at") >= F.col("lo")) & (F.col("at") + F.col("size") <= F.col("lo") + F.size("plain")))


def _own(column: str) -> Column:
    return F.slice(column, F.col("at") - F.col("lo") + 1, F.col("size"))


def _runs(beside: DataFrame, runs: DataFrame) -> DataFrame:
    """Pairs of a document and an item that share RUN consecutive words, or all words of a shorter item, in any case."""
    met = _along(beside, runs).where(_own("plain") == F.col("item_plain"))
    none = F.lit(0).cast("long")
    return met.groupBy("doc", "item", "words").agg(F.min("at").cast("long").alias("first_word")).select(
        "doc", "item", none.alias("n_windows"), F.greatest(F.col("words") - WINDOW + 1, F.lit(1)).cast("long").alias("item_windows"),
        none.alias("n_slots"), none.alias("changed_slots"), "first_word",
    )


def _held(beside: DataFrame, known: DataFrame, kind: str) -> DataFrame:
    """leaks() by one kind of template, with columns doc and item."""
    met = _along(beside, known).withColumn("doc_said", _own("said")).where(_own(kind) == F.col("item_template"))
    slots = F.filter(
        F.arrays_zip("item_template", "item_said", "doc_said"), lambda x: x["item_template"].isin(NAME, NUMBER, UNIT)
    )
    plain = lambda w: F.regexp_replace(F.lower(w), r"[^\p{L}\p{N}%€£°]+", "")
    aligned = (
        met.select(
            "doc",
            "item",
            "item_windows",
            "at",
            "item_at",
            "shift",
            F.transform(slots, lambda x: F.struct(plain(x["item_said"]).alias("asked"), plain(x["doc_said"]).alias("found"))).alias("slots"),
        )
        .groupBy("doc", "item", "item_windows", "shift")
        .agg(F.collect_set("item_at").alias("starts"), F.min("at").alias("at"), F.array_distinct(F.flatten(F.collect_set("slots"))).alias("slots"))
    )
    values = lambda side: F.size(F.array_distinct(F.transform("slots", lambda x: x[side])))
    consistent = (F.size("slots") == values("asked")) & (F.size("slots") == values("found"))
    changed = F.size(F.filter("slots", lambda x: x["asked"] != x["found"]))
    return (
        aligned.where(consistent)
        .groupBy("doc", "item", "item_windows")
        .agg(
            F.size(F.array_distinct(F.flatten(F.collect_set("starts")))).cast("long").alias("n_windows"),
            F.max(values("asked")).cast("long").alias("n_slots"),
            F.max(changed).cast("long").alias("changed_slots"),
            F.min("at").cast("long").alias("first_word"),
        )
        .where(F.col("n_windows") >= LEAK_FROM * F.col("item_windows"))
        .select(
            "doc",
            "item",
            "n_windows",
            F.col("item_windows").cast("long").alias("item_windows"),
            "n_slots",
            "changed_slots",
            "first_word",
        )
    )
