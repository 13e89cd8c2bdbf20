"""Line deduplication: SimHash of normalised lines, joins on pigeonhole blocks, edit similarity, one line kept per group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tractwise.llm.graph import components
from tractwise.llm.tables import Stored
from tractwise.session import replicated_if_small

#: A signature has this many blocks; a word counts in the block that the top bits of its hash name.
BLOCKS = 8
#: The bits of a block in a number: the first two of every four of its ``LONG`` lowest bits.
LONG, PLACES = 56, 0x33333333333333
#: Widths of the counters that share one sum, each for blocks of fewer than 2 ** width words.
WIDTHS = (4, 8)
#: Of a line's different words so many count in its signature, or half of that: those whose hashes have
#: zeros in as many bits, from ``THINNED`` on, as it takes. A sketch of long lines; the edit similarity
#: is that of the whole lines.
COUNTED, THINNED = 32, 45
#: A key is made of consecutive blocks that hold this many counted words together; in lines of fewer
#: than ``FEW`` one word less, as a change leaves them little else.
WORDS, FEW = 4, 12
#: ASCII white space besides the space.
SPACES = "\t\n\x0b\f\r"
#: Two lines are compared if at most so many of the 224 bits of their signatures differ.
NEAR_BITS = 64
#: Where a line shares its keys with more than ``CROWD`` lines, on average, rounds first compare every line with
#: its nearest candidate; they end at ``EACH`` candidates a line or when fewer than one comparison in ``HITS`` links.
CROWD, EACH, HITS = 300, 8, 20
#: Edit distances are dealt to tasks of so many pairs.
PAIRS = 4000


def _long(bits: int) -> Column:
    return F.lit(bits).cast("bigint")


def _once(df: DataFrame, keep: list[str], **columns: Column) -> DataFrame:
    """``keep`` and the new columns. The planner keeps a step of its own for what is costly and read more than
    once afterwards, so such a column is computed once; one read inside a lambda must be read outside of it too."""
    return df.select(*keep, *[c.alias(name) for name, c in columns.items()])


def _step(df: DataFrame, keep: list[str], **columns: Column) -> DataFrame:
    """Like ``_once``, as the output of a generator, through which no condition is pushed down."""
    fields = F.struct(*[c.alias(name) for name, c in columns.items()])
    return df.select(*keep, F.explode(F.array(fields)).alias("__new")).select(*keep, "__new.*")


def _words(line: str) -> Column:
    """A line normalised to its words: lower case, parted by any ASCII white space."""
    other = F.lit(False)
    for c in SPACES:
        other = other | F.contains(F.col(line), F.lit(c))
    plain = F.when(other, F.translate(line, SPACES, " " * len(SPACES))).otherwise(F.col(line))
    return F.array_remove(F.split(F.lower(plain), " "), "")


def _majority(hashes: Column, n: Column, width: int) -> Column:
    """Bit p of ``PLACES`` is set where more than half of the ``n`` ``hashes`` have it, for ``n`` < 2 ** ``width``.

    Each sum counts the bits at a distance of ``width`` at once, in counters of ``width``
    bits. What a count lacks of a majority is filled up so that its highest bit tells.
    """
    ones = _long(sum(1 << at for at in range(0, LONG, width)))
    fill = (F.lit((1 << width - 1) - 1).cast("bigint") - F.shiftright(n, 1)) * ones
    out = F.lit(0).cast("bigint")
    for k in range(width):
        if PLACES >> k & 1:
            count = F.aggregate(
                hashes, F.lit(0).cast("bigint"), lambda total, x: total + F.shiftrightunsigned(x, k).bitwiseAND(ones))
            most = F.shiftrightunsigned(count + fill, width - 1).bitwiseAND(ones)
            out = out.bitwiseOR(F.shiftleft(most, k))
    return out


def _block_count(b: int) -> Column:
    return F.shiftrightunsigned("counts", 8 * b).bitwiseAND(F.lit(255))


def signed(df: DataFrame, keep: list[str]) -> DataFrame:
    """``df`` with the SimHash of its distinct word ``hashes``: ``bits`` of each block, and ``counts`` of their words, eight bits each.

    A block is a SimHash of its own, of the words that fall in it: each bit is what most
    of their hashes have there. A word that changes touches the block it leaves and the
    one it enters, so lines that differ in e words agree in all of at least
    ``BLOCKS`` - 2 e blocks, where a SimHash over all words would differ a little everywhere.
    """
    n = F.size("hashes")
    spare = F.greatest(F.ceil(F.log2(n / COUNTED)), F.lit(0)).cast("int")
    mask = F.shiftleft(F.call_function("shiftleft", F.lit(1).cast("bigint"), spare) - 1, THINNED)
    df = _once(df, [*keep, "hashes"], mask=F.when(n > COUNTED, mask).otherwise(0))
    thin = F.filter("hashes", lambda h: h.bitwiseAND(F.col("mask")) == 0)
    # sorted, the words of a block stand together; a count has eight bits
    few = F.slice(F.sort_array(F.when(F.col("mask") == 0, F.col("hashes")).otherwise(thin)), 1, 255)
    df = _once(df, keep, words=few)
    # the top three bits of a hash name its block, eight bits each in the counts
    counts = F.aggregate("words", F.lit(0).cast("bigint"), lambda total, h: total + F.call_function(
        "shiftleft", F.lit(1).cast("bigint"), F.shiftrightunsigned(h, 58).bitwiseAND(F.lit(56)).cast("int")))
    df = _once(df, [*keep, "words"], counts=counts)
    blocks, before = {}, F.lit(0).cast("bigint")
    for b in (*range(BLOCKS // 2, BLOCKS), *range(BLOCKS // 2)):  # negative hashes are sorted first
        own = _block_count(b)
        part = F.slice("words", (before + 1).cast("int"), own.cast("int"))
        alone = F.get("words", before.cast("int")).bitwiseAND(_long(PLACES))
        blocks[b] = (
            F.when(own == 0, F.lit(0).cast("bigint")).when(own == 1, alone)
            .when(own < 1 << WIDTHS[0], _majority(part, own, WIDTHS[0])).otherwise(_majority(part, own, WIDTHS[1])))
        before = before + own
    there = F.col("counts").isNotNull()
    return _once(df, [*keep, "counts"], bits=F.when(there, F.array(*[blocks[b] for b in range(BLOCKS)])))


def _packed(blocks: str) -> list[Column]:
    """Two blocks in each of four numbers: the second one takes the places that the first leaves."""
    return [F.get(blocks, F.lit(i)).bitwiseOR(F.shiftleft(F.get(blocks, F.lit(i + 1)), 2)).alias(f"s{i // 2}")
            for i in range(0, BLOCKS, 2)]


PACKED = [f"s{i}" for i in range(BLOCKS // 2)]


KEYS = [f"k{b}" for b in range(BLOCKS)]


def line_keys(groups: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` and the keys ``k0`` to ``k7`` of a packed signature: from each block on, as many neighbours
    as hold ``WORDS`` (or one less) together.

    A key is shared by lines that agree in those blocks: of ``BLOCKS`` keys, a changed
    word takes away those that have one of its two blocks.
    """
    signs = {f"b{2 * i + half}": F.shiftrightunsigned(c, 2 * half).bitwiseAND(_long(PLACES))
             for i, c in enumerate(PACKED) for half in (0, 1)}
    rows = _once(groups.where(F.col("counts").isNotNull()), keep, **signs, **{f"n{b}": _block_count(b) for b in range(BLOCKS)})
    total = sum((F.col(f"n{b}") for b in range(BLOCKS)), F.lit(0).cast("bigint"))
    rows = rows.withColumn("needed", F.when(total < FEW, WORDS - 1).otherwise(WORDS))
    keys = []
    for a in range(BLOCKS):
        key = None
        for k in range(1, BLOCKS - 1):
            window = [(a + i) % BLOCKS for i in range(k)]
            held = sum((F.col(f"n{b}") for b in window), F.lit(0).cast("bigint"))
            of = F.xxhash64(F.lit(a), F.lit(k), *[F.col(f"b{b}") for b in window])
            key = F.when(held >= F.col("needed"), of) if key is None else key.when(held >= F.col("needed"), of)
        # too few words in so many blocks: the whole signature
        keys.append(key.otherwise(F.xxhash64(F.lit(BLOCKS), *[F.col(f"b{b}") for b in range(BLOCKS)])))
    return rows.select(*keep, *[key.alias(name) for key, name in zip(keys, KEYS)])


def line_signatures(docs: DataFrame, min_words: int) -> DataFrame:
    """``doc_id``, ``pos``, ``h1``, ``h2``, ``size``, ``s0`` to ``s3``, ``counts`` of every line that has a word.

    ``h1`` and ``h2`` are one hash of 128 bits of the normalised line and ``size`` its
    length. ``s0`` to ``s3`` are the signature and ``counts`` the words of its blocks, eight
    bits each; NULL for lines of fewer than ``min_words`` words. All is computed within the
    line, so nothing is shuffled.
    """
    lines = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    # told by the line itself: a condition on its words would be pushed below them, and compute them twice
    some = F.col("line").rlike(r"[^\x20\x09-\x0D]")
    worded = _once(lines.where(some), ["doc_id", "pos"], w=_words("line"))
    keys = ["doc_id", "pos", "h1", "h2", "size"]
    worded = _once(worded, ["doc_id", "pos"], every=F.transform("w", lambda w: F.xxhash64(w)),
                   size=F.length(F.array_join("w", " ")))
    hashed = _once(
        worded, ["doc_id", "pos", "size"], h1=F.xxhash64("every"), h2=F.xxhash64(F.lit(1), "every"),
        hashes=F.when(F.size("every") >= min_words, F.array_distinct("every")))
    return signed(hashed, keys).select(*keys, *_packed("bits"), "counts")


def _with_signatures(pairs: DataFrame, groups: DataFrame, stored: Stored) -> DataFrame:
    """``pairs`` (``u``, ``v``) with both lines' lengths and signatures: only lines of some pair are looked up."""
    ends = pairs.select(F.col("u").alias("h1")).unionByName(pairs.select(F.col("v").alias("h1"))).distinct()
    known = stored(groups.join(replicated_if_small(stored(ends)), "h1").select("h1", "size", *PACKED).dropDuplicates(["h1"]))
    for end in ("u", "v"):
        side = known.select(F.col("h1").alias(end), *[F.col(c).alias(f"{c}_{end}") for c in ("size", *PACKED)])
        pairs = pairs.join(replicated_if_small(side), end)
    return pairs


def _bits() -> Column:
    return sum((F.bit_count(F.col(f"{c}_u").bitwiseXOR(F.col(f"{c}_v"))) for c in PACKED), F.lit(0))


def _near(similarity: float) -> Column:
    """Whether lengths and signatures leave room for the edit similarity."""
    longer = F.greatest("size_u", "size_v")
    apart = F.abs(F.col("size_u") - F.col("size_v")) <= F.floor(longer * F.lit(1 - similarity) + F.lit(1e-9))
    return apart & (_bits() <= NEAR_BITS)


def buckets(groups: DataFrame, stored: Stored) -> tuple[DataFrame, DataFrame]:
    """Pairs of lines (``u``, ``v``) that share a key, each line with the key's smallest; and the lines of
    keys with more than two (``key``, ``u``).

    One count per key tells both lines of most keys; only for the others the lines are
    looked up once more.
    """
    rows = line_keys(groups, ["h1"]).select(F.col("h1").alias("u"), F.explode(F.array(*KEYS)).alias("key"))
    shared = stored(rows.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.min("u").alias("low"), F.max("u").alias("high")).where("n > 1"))
    many = shared.where("n > 2").select(F.col("key").alias("__key"), "low")
    members = stored(rows.join(replicated_if_small(many), F.col("key") == F.col("__key")).select("key", "u", "low"))
    pairs = shared.where("n = 2 and low != high").select(F.col("low").alias("u"), F.col("high").alias("v")).unionByName(
        members.where("u != low").select(F.col("low").alias("u"), F.col("u").alias("v")))
    return stored(pairs.distinct()), members.select("key", "u")


def _candidates(
    members: DataFrame, linked: DataFrame, groups: DataFrame, similarity: float, stored: Stored, after: DataFrame | None,
) -> DataFrame:
    """``u``, ``v``, ``bits`` of near pairs of lines that share a key and that ``linked`` components do not yet
    connect, once for each key; with ``after``, what a round compared, only of its lines ``u``, and those later in order."""
    lines = members.select("u").distinct().join(replicated_if_small(linked), F.col("u") == F.col("node"), "left").select(
        F.col("u").alias("h1"), F.coalesce("component", "u").alias("component"))
    known = stored(groups.select("h1", "size", *PACKED).join(replicated_if_small(stored(lines)), "h1").dropDuplicates(["h1"]))

    def side(end: str) -> DataFrame:
        own = known.select(F.col("h1").alias(end), *[F.col(c).alias(f"{c}_{end}") for c in ("component", "size", *PACKED)])
        if after is not None and end == "u":
            own = own.join(replicated_if_small(after.select("u", "last")), "u")
        return members.select(F.col("key").alias(f"key_{end}"), F.col("u").alias(end)).join(replicated_if_small(own), end)

    apart = (F.col("u") < F.col("v")) & (F.col("component_u") != F.col("component_v")) & (F.col("key_u") == F.col("key_v"))
    if after is not None:
        apart = apart & (F.struct(_bits().alias("bits"), "v") > F.col("last"))
    return side("u").join(side("v"), apart & _near(similarity)).select("u", "v", _bits().alias("bits"))


def nearest_pairs(
    members: DataFrame, linked: DataFrame, groups: DataFrame, similarity: float, stored: Stored, after: DataFrame | None = None,
) -> DataFrame:
    """Of each line ``u`` that has candidates their number ``n`` and the nearest, by differing bits, as ``v`` and ``last``."""
    found = _candidates(members, linked, groups, similarity, stored, after).groupBy("u").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("bits", "v")).alias("last"))
    return stored(found.select("u", F.col("last.v").alias("v"), "n", "last"))


def other_pairs(
    members: DataFrame, linked: DataFrame, groups: DataFrame, similarity: float, stored: Stored, after: DataFrame | None = None,
) -> DataFrame:
    """Near pairs of lines that share a key and that ``linked`` components do not yet connect."""
    return _candidates(members, linked, groups, similarity, stored, after).select("u", "v").distinct()


def all_links(
    links: DataFrame, members: DataFrame, docs: DataFrame, groups: DataFrame, similarity: float, stored: Stored,
) -> DataFrame:
    """``links`` and what else it takes to connect all similar lines that share a key.

    Where a key holds many lines that the leaders leave apart, every line is compared with
    its nearest candidate first, then with the next one of another component: most of a
    group is one component after few comparisons, and only what is still apart when these
    stop to link is compared pair by pair.
    """
    linked, after = components(links, stored), None
    shared = members.groupBy("key").agg(F.count(F.lit(1)).alias("n")).agg(F.sum(F.col("n") * F.col("n")), F.sum("n")).first()
    crowded = (shared[0] or 0) > CROWD * (shared[1] or 0)
    while crowded:
        nearest = nearest_pairs(members, linked, groups, similarity, stored, after)
        n, candidates = nearest.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        if candidates <= EACH * n:
            break
        found = similar_lines(nearest.select("u", "v"), docs, groups, similarity, stored)
        links, after = stored(links.unionByName(found)), nearest
        linked = components(links, stored)
        if found.count() * HITS < n:
            break
    rest = other_pairs(members, linked, groups, similarity, stored, after)
    return links.unionByName(similar_lines(rest, docs, groups, similarity, stored))


def _without_common_ends(pairs: DataFrame, keep: list[str]) -> DataFrame:
    """``lu`` and ``lv`` without the words both begin with and those both end with, and ``by_words``, what it takes to
    edit word by word (NULL where their numbers differ).

    What is left has the edit distance of the whole lines: each word keeps the space
    after it, and no best alignment changes a common begin or end.
    """
    def differs(a: Column, b: Column) -> Column:
        return F.array_position(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)), F.lit(False))

    def rest(words: str) -> Column:
        # equal lines differ nowhere: position 0, nothing is left
        behind = F.least(F.col("back") - 1, F.least(F.size("a"), F.size("b")) - F.col("at") + 1)
        n = F.when(F.col("at") > 0, F.size(words) - F.col("at") + 1 - behind).otherwise(0)
        return F.slice(words, F.greatest("at", F.lit(1)).cast("int"), n.cast("int"))

    def joined(words: str) -> Column:
        return F.when(F.size(words) > 0, F.concat(F.array_join(words, " "), F.lit(" "))).otherwise("")

    now = _step(pairs, keep, a=F.split("lu", " "), b=F.split("lv", " "))
    now = _step(now, [*keep, "a", "b"], at=differs(F.col("a"), F.col("b")), back=differs(F.reverse("a"), F.reverse("b")))
    now = _step(now, keep, a=rest("a"), b=rest("b"))
    # word by word, a way of editing: the distance is at most that, and mostly it is
    changes = F.aggregate(
        F.zip_with("a", "b", lambda x, y: F.when(x == y, 0).otherwise(F.levenshtein(x, y))), F.lit(0), lambda total, n: total + n)
    return _step(now, keep, lu=joined("a"), lv=joined("b"), by_words=F.when(F.size("a") == F.size("b"), changes))


def similar_lines(pairs: DataFrame, docs: DataFrame, groups: DataFrame, similarity: float, stored: Stored) -> DataFrame:
    """Those of ``pairs`` (``u``, ``v``) whose normalised lines have the edit similarity.

    The text of a line is taken from one of its places.
    """
    pairs = stored(pairs)
    tasks = -(-pairs.count() // PAIRS) or 1
    ends = pairs.select(F.col("u").alias("h1")).unionByName(pairs.select(F.col("v").alias("h1"))).distinct()
    places = groups.join(ends, "h1").groupBy("h1").agg(F.min("first").alias("first")).select(
        "h1", F.col("first.doc_id").alias("doc_id"), F.col("first.pos").alias("pos"))
    texts = stored(
        docs.join(replicated_if_small(stored(places)), "doc_id")
        .select("h1", F.get(F.split("text", "\n"), F.col("pos")).alias("line"))
        .select("h1", F.array_join(_words("line"), " ").alias("line"))
        .dropDuplicates(["h1"]))
    longer = F.greatest(F.length("lu"), F.length("lv"))
    allowed = F.floor(longer * F.lit(1 - similarity) + F.lit(1e-9)).cast("int")
    apart = F.abs(F.length("lu") - F.length("lv"))
    both = (
        pairs.join(texts.select(F.col("h1").alias("u"), F.col("line").alias("lu")), "u")
        .join(texts.select(F.col("h1").alias("v"), F.col("line").alias("lv")), "v")
        .where(apart <= allowed).withColumn("allowed", allowed)
        .repartition(tasks, "u", "v"))  # a line of many pairs would keep one task busy
    # the distance takes time in proportion to length times limit, so only what differs is compared
    cut = _without_common_ends(both, ["u", "v", "allowed"])
    close = (longer <= F.col("allowed")) | (F.coalesce("by_words", F.col("allowed") + 1) <= F.col("allowed"))
    for below, limit in ((-1, 16), (16, 64)):  # most similar lines are found within few edits; only the others take the whole limit
        close = close | ((F.col("allowed") > below) & (F.call_function("levenshtein", "lu", "lv", F.least("allowed", F.lit(limit))) >= 0))
    close = close | ((F.col("allowed") > 64) & (F.call_function("levenshtein", "lu", "lv", F.col("allowed")) >= 0))
    return stored(cut.where(close).select("u", "v"))


def duplicate_lines(
    docs: DataFrame, *, min_words: int = 5, similarity: float = 0.9, stored: Stored | None = None,
    id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """The lines to drop: ``doc_id``, ``pos`` (from 0) and ``keeper_doc``, ``keeper_pos``.

    Lines are the parts of the text between line feeds. Those whose normalised words
    agree are one group, whatever their number and length; groups of ``min_words`` words or
    more are linked if the edit similarity of their normalised lines, ``1 - distance /
    longer length``, reaches ``similarity``. Compared are those that share a key of their
    SimHashes (see ``signed``) and differ in at most ``NEAR_BITS`` bits of them. Of each
    connected group the line with the smallest id, then place, stays. Lines without a
    word, NULL and empty texts and rows without an id take no part; lines of any length
    are compared whole. Repeated rows are one document; an empty table gives an empty
    result. Only the two columns are read, so others may have any name.
    """
    stored = stored or Stored(docs.sparkSession)
    docs = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text")).where(
        F.col("doc_id").isNotNull())
    lines = stored(line_signatures(docs, min_words))
    first = F.min(F.struct("doc_id", "pos")).alias("first")
    groups = stored(lines.groupBy("h1", "h2").agg(
        F.count(F.lit(1)).alias("n"), first, *[F.any_value(c).alias(c) for c in ("size", *PACKED, "counts")]))
    pairs, members = buckets(groups, stored)
    # all lines that share a key: what is compared is looked up among them
    ends = pairs.select(F.col("u").alias("h1")).unionByName(pairs.select(F.col("v").alias("h1"))).distinct()
    known = stored(groups.join(replicated_if_small(stored(ends)), "h1"))
    near = _with_signatures(pairs, known, stored).where(_near(similarity)).select("u", "v")
    # what the leaders connect needs no more comparing, so a bucket of copies stays cheap
    links = similar_lines(near, docs, known, similarity, stored)
    linked = components(all_links(links, members, docs, known, similarity, stored), stored)
    # a group found alone keeps its own first line; a component keeps the first of its groups
    united = stored(groups.join(replicated_if_small(linked), groups["h1"] == linked["node"], "left").where(
        "n > 1 or component is not null").select("h1", "h2", "first", "component"))
    # broadcast where few: by a shuffle, the lines of a large component would meet in one task
    best = replicated_if_small(stored(united.where("component is not null").groupBy("component").agg(
        F.min("first").alias("best"))))
    keepers = stored(united.join(best, "component", "left").select("h1", "h2", F.coalesce("best", "first").alias("keep")))
    drops = lines.select("doc_id", "pos", "h1", "h2").join(replicated_if_small(keepers), ["h1", "h2"]).where(
        ~((F.col("doc_id") == F.col("keep.doc_id")) & (F.col("pos") == F.col("keep.pos"))))
    return drops.select("doc_id", "pos", F.col("keep.doc_id").alias("keeper_doc"), F.col("keep.pos").alias("keeper_pos"))


def dedup_lines(
    docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", **options
) -> DataFrame:
    """``docs`` with the lines that ``duplicate_lines`` finds taken out of the text.

    Adds ``dropped_lines``, the places of those lines, NULL where there are none, in place of
    an own column of that name. Other lines, their order and all other columns stay; a document of which no line is left
    has an empty text.
    """
    stored = Stored(docs.sparkSession)
    drops = duplicate_lines(docs, id_column=id_column, text_column=text_column, stored=stored, **options)
    places = stored(drops.groupBy(F.col("doc_id").alias("__id")).agg(
        F.sort_array(F.collect_set("pos")).alias("dropped_lines")))
    stay = F.filter(F.split(F.col(text_column), "\n"),
                    lambda line, i: ~F.array_contains(F.col("dropped_lines"), i))
    text = F.when(F.col("dropped_lines").isNull(), F.col(text_column)).otherwise(F.array_join(stay, "\n"))
    return (
        docs.drop("dropped_lines").join(replicated_if_small(places), F.col(id_column) == F.col("__id"), "left")
        .drop("__id").withColumn(text_column, text)
    )
