"""Fuzzy line deduplication (native).

Lines are normalised (lower case, runs of anything but letters and digits
become one space) and those of at least ``min_words`` words or ``min_letters``
letters and digits take part, so that lines of scripts without spaces do. Equal
normalised lines are one class. Classes of fewer words get a SimHash over their
character 3-grams, others a 64-bit SimHash over their words
of more than three letters (over all, if they have none): shorter words are
mostly function words, which bring lines close that share nothing else, and
the pairs of such lines grow with the square of the corpus. Classes whose
SimHashes differ in at most three bits agree on two of five bit blocks
(pigeonhole), so they meet in one of ten block tables. A link
needs a distance of three bits at most and an edit similarity of at least
``similarity``. Of every connected group the first occurrence, by doc_id and
line number, stays; every other occurrence is removed.

Groups of thousands of variants share blocks, so pairs are not listed bucket
by bucket: every member is first compared with the bucket's smallest member,
and only members that are still in different groups after that are compared
with each other. No link between different groups can be missed, and a group
of ``g`` variants costs about ``g`` comparisons.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bloom, components, maybe_in, split_by_bloom, stored

BITS = 3
GRAM = 3  # characters of a feature, in lines of few words
BAND = 8  # edits of the first comparison; most links are of few
WORDS = 127  # words whose counters fit eight to a long
SHORT = 3  # letters of a word that carries no weight
GAP_WORDS = 256  # words around which a gap's place is tried (in the square of them)
_BLOCKS = [(0, 13), (13, 13), (26, 13), (39, 13), (52, 12)]  # (first bit, bits): five, of which two must agree


def normalised(line: Column) -> Column:
    # runs of anything else, but for single spaces, which would become themselves
    return F.trim(F.regexp_replace(F.lower(line), r"[^\p{L}\p{N} ][^\p{L}\p{N}]*| [^\p{L}\p{N}]+", " "))


def _packed_sums(h: str) -> list[Column]:
    """8 sums of eight 8-bit counters each, for at most ``WORDS`` words: byte j of
    sum i counts the words that set bit 8j + i."""
    return [F.expr(f"sum(shiftrightunsigned({h}, {i}) & {0x0101010101010101}L)").alias(f"s{i}") for i in range(8)]


def _wide_sums() -> list[Column]:
    """32 sums of two 32-bit counters each, of packed sums: bytes k and k + 4 of
    sum i in ``w{i}_{k}``."""
    return [F.expr(f"sum(shiftrightunsigned(s{i}, {8 * k}) & {0xFF000000FF}L)").alias(f"w{i}_{k}") for i in range(8) for k in range(4)]


# A bit of a SimHash is set where its counter is above half of the ``n`` words. All
# counters of a long are compared by one sum, which carries into a counter's highest
# bit where it is; 64 conditions make methods that the JVM does not compile.

def _simhash() -> Column:
    """Of packed sums. The last byte is added by itself: its carry is the sign."""
    terms = []
    for i in range(8):
        low = f"((s{i} & {(1 << 56) - 1}L) + (127L - n div 2) * {0x01010101010101}L) & {0x80808080808080}L"
        last = f"shiftleft((shiftrightunsigned(s{i}, 56) + (127L - n div 2)) & 128L, 56)"
        terms.append(f"shiftrightunsigned(({low}) | {last}, {7 - i})")
    return F.expr(" | ".join(terms))


def _wide_simhash() -> Column:
    """Of wide sums (fewer than 2^30 words)."""
    terms = []
    for i in range(8):
        for k in range(4):
            over = f"(w{i}_{k} + ({(1 << 30) - 1}L - n div 2) * {(1 << 32) + 1}L) & {(1 << 62) | (1 << 30)}L"
            to = 8 * k + i - 30
            terms.append(f"shiftleft({over}, {to})" if to > 0 else f"shiftrightunsigned({over}, {-to})")
    return F.expr(" | ".join(terms))


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("row"))


def _lines(docs: DataFrame, min_words: int, min_letters: int) -> DataFrame:
    """Every line that takes part: place, two hashes of the normalised line,
    SimHash. The counters are summed before they are shuffled: one row of eight
    sums for ``WORDS`` words of a line. Few lines are longer; the sums of their
    parts are added up by themselves. A row that is repeated whole has its lines
    as often (``copy`` keeps their words apart)."""
    lines = _rows(docs).withColumn("copy", F.monotonically_increasing_id()).select("copy", "doc_id", "row", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    lines = lines.select("copy", "doc_id", "row", "line_no", normalised(F.col("line")).alias("norm"))
    # words are split in a step of their own: once, although they are used several times
    lines = lines.select("copy", "doc_id", "row", "line_no", F.xxhash64("norm").alias("h1"), F.xxhash64("norm", F.lit(1)).alias("h2"),
                         F.split("norm", " ").alias("split"), F.col("norm").rlike(f"[^ ]{{{SHORT + 1}}}").alias("weighty"), "norm")
    short = F.size("split") < min_words
    grams = F.expr(f"transform(sequence(1, greatest(char_length(norm) - {GRAM - 1}, 1)), i -> substring(norm, i, {GRAM}))")
    out = F.char_length(F.replace(F.col("norm"), F.lit(" "), F.lit(""))) < min_letters
    parts = lines.select("copy", "doc_id", "row", "line_no", "h1", "h2",
                         F.when(short, F.when(out, F.array(F.lit(""))).otherwise(grams)).otherwise(F.col("split")).alias("words"),
                         # one condition on every word, which cannot be pushed below the explode (and
                         # an outer explode, which adds none): lines are normalised once
                         F.when(short, F.when(out, F.lit(1 << 30)).otherwise(F.lit(0))).when(F.col("weighty"), F.lit(SHORT + 1)).otherwise(F.lit(0)).alias("from_length"))
    line = ["doc_id", "row", "line_no", "h1", "h2"]
    tokens = parts.select("copy", *line, "from_length", F.size("words").alias("size"), F.posexplode_outer("words").alias("at", "word"))
    tokens = tokens.where(F.char_length("word") >= F.col("from_length")).select(
        "copy", *line, F.expr(f"at div {WORDS}").alias("part"), (F.col("size") > WORDS).alias("long"), F.xxhash64("word").alias("h"))
    # ``long`` is summed, not a key: a filter on a key would pass below the shuffle, which both kinds of lines share
    sums = tokens.groupBy("copy", *line, "part").agg(F.max("long").alias("long"), F.count("*").alias("n"), *_packed_sums("h"))
    whole = sums.where("not long").select(*line, _simhash().alias("sim"))
    added = sums.where("long").groupBy(*line).agg(F.sum("n").alias("n"), *_wide_sums())
    return whole.unionByName(added.select(*line, _wide_simhash().alias("sim")))


def _posts(classes: DataFrame) -> DataFrame:
    """(bucket, h1, sim) for each of the ten block pairs, with the bucket's
    smallest member; buckets of one are gone."""
    part = [f"(shiftrightunsigned(sim, {at}) & {(1 << n) - 1}L)" for at, n in _BLOCKS]
    keys = [f"{t}L * {1 << 26}L + {part[i]} * {1 << 13}L + {part[j]}" for t, (i, j) in enumerate(combinations(range(5), 2))]
    posts = classes.select("h1", "sim", F.explode(F.expr(f"array({', '.join(keys)})")).alias("bucket"))
    same = Window.partitionBy("bucket")
    posts = posts.select("bucket", "h1", "sim", F.count("*").over(same).alias("n"), F.min(F.struct("h1", "sim")).over(same).alias("p"))
    return posts.where("n > 1").select("bucket", "h1", "sim", F.col("p.h1").alias("p1"), F.col("p.sim").alias("psim"))


def _verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame, similarity: float) -> DataFrame:
    """Links among ``pairs`` (a, b: h1 of two classes): classes whose normalised
    lines differ by few enough edits. Only the lines in question are fetched,
    from the first place of each class."""
    wanted = stored(pairs.select(F.explode(F.array("a", "b")).alias("h1")).distinct()
                    .join(classes.select("h1", "h2", "first"), "h1")
                    .select("h1", "h2", F.col("first.row").alias("row"), F.col("first.line_no").alias("line_no")), "line-wanted")
    bitmap = stored(bloom(wanted.select("row").distinct(), "row"), "line-bloom")
    bits = bitmap.agg(F.max("n_bits")).first()[0] or 1
    held = maybe_in(_rows(docs).select("row", "text"), "row", bitmap, bits)
    line = F.expr("get(split(text, '\\n'), line_no)")
    lines = stored(held.join(wanted, "row").select("h1", F.struct("h1", "h2").alias("id"), normalised(line).alias("norm"))
                   .dropDuplicates(["id"]), "line-texts")
    a = lines.select(F.col("h1").alias("a"), F.col("id").alias("ida"), F.col("norm").alias("na"))
    b = lines.select(F.col("h1").alias("b"), F.col("id").alias("idb"), F.col("norm").alias("nb"))
    longer = "greatest(char_length(na), char_length(nb))"
    both = pairs.join(a, "a").join(b, "b").withColumn("most", F.expr(f"cast({1 - similarity:.6f}D * {longer} + 1e-9D as int)"))
    both = both.where("abs(char_length(na) - char_length(nb)) <= most")
    # kept with the pairs, as a filter would evaluate the steps again for each use
    return stored(both.select("ida", "idb", "most", F.split("na", " ").alias("wa"), F.split("nb", " ").alias("wb"))
                  .transform(_compared), "line-compared").where("near").select(F.col("ida").alias("a"), F.col("idb").alias("b"))


def _compared(both: DataFrame) -> DataFrame:
    """(ida, idb, near): whether the words ``wa`` and ``wb`` are ``most`` edits apart
    at most. Words that both begin or end with change no distance and are cut off
    first (the distance costs the square of the length). The edits of each word,
    with the words of one gap where one side has more, are enough edits for the
    whole; only where these are too many, the rest is compared as a whole."""
    differ = "zip_with({a}, {b}, (x, y) -> not (x <=> y))"  # where one has no word, this is true
    both = both.select("ida", "idb", "most", "wa", "wb", F.expr(f"array_position({differ.format(a='wa', b='wb')}, true)").alias("at"))
    both = both.select("ida", "idb", "most", "at", F.expr("reverse(slice(wa, greatest(at, 1), size(wa)))").alias("ra"),
                       F.expr("reverse(slice(wb, greatest(at, 1), size(wb)))").alias("rb"))
    both = both.select("ida", "idb", "most", "at", "ra", "rb", F.expr(f"array_position({differ.format(a='ra', b='rb')}, true)").alias("till"))
    middle = "reverse(slice({r}, greatest(till, 1), size({r})))"
    both = both.select("ida", "idb", "most", "at", F.expr(middle.format(r="ra")).alias("ma"), F.expr(middle.format(r="rb")).alias("mb"))
    # edits of the words that stand at the same place from the front and from the back,
    # and the words of a gap between them
    both = both.select("ida", "idb", "most", "at", "ma", "mb", F.expr("if(size(ma) < size(mb), ma, mb)").alias("fewer"), F.expr("if(size(ma) < size(mb), mb, ma)").alias("more"))
    both = both.select("ida", "idb", "most", "at", "ma", "mb", "more", F.expr("size(fewer)").alias("m"), F.expr("size(more) - size(fewer)").alias("gap"),
                       F.expr("transform(fewer, (x, i) -> if(x = more[i], 0, levenshtein(x, more[i])))").alias("front"),
                       F.expr("transform(fewer, (x, i) -> if(x = more[i + size(more) - size(fewer)], 0, levenshtein(x, more[i + size(more) - size(fewer)])))").alias("back"))
    total = "aggregate({}, 0, (t, d) -> t + d)".format
    around = f"{total('slice(front, 1, k)')} + {total('slice(back, k + 1, m)')} + char_length(array_join(slice(more, k + 1, gap), ' ')) + 1"
    enough = f"case when gap = 0 then {total('front')} <= most when m <= {GAP_WORDS} then exists(sequence(0, m), k -> {around} <= most) else false end"
    both = both.select("ida", "idb", "most", F.expr("at = 0").alias("same"), F.expr(enough).alias("enough"),
                       # every word with a space behind it, so that a rest of no words has no length
                       *[F.expr(f"array_join(concat({m}, array('')), ' ')").alias(f"t{m}") for m in ("ma", "mb")])
    # a banded distance: narrow bands first, and the wider ones only for what they
    # leave open, up to the full one
    steps = [BAND << 2 * k for k in range(8)]
    bands = [f"levenshtein(tma, tmb, least(most, {BAND})) >= 0"]
    bands += [f"most > {n} and levenshtein(tma, tmb, least(most, {wider})) >= 0" for n, wider in zip(steps, steps[1:])]
    bands.append(f"most > {steps[-1]} and levenshtein(tma, tmb, most) >= 0")
    return both.select("ida", "idb", F.expr(" or ".join(["same", "enough", *bands])).alias("near"))


def fuzzy_line_groups(docs: DataFrame, min_words: int = 5, similarity: float = 0.9, min_letters: int = 12) -> tuple[DataFrame, DataFrame]:
    """The lines that take part (doc_id, row, line_no, h1, h2, sim) and, for every
    class with more than one occurrence or with links, its group's first place
    (h1, h2, first)."""
    lines = stored(_lines(docs, min_words, min_letters), "line-places")
    classes = stored(lines.groupBy("h1", "h2").agg(
        F.min(F.struct("doc_id", "line_no", "row")).alias("first"), F.min("sim").alias("sim"), F.count("*").alias("n")), "line-classes")
    posts = stored(_posts(classes), "line-posts")

    apart = "bit_count(sim ^ psim)"
    stars = posts.where(f"h1 <> p1 and {apart} <= {BITS}").select(F.col("p1").alias("a"), F.col("h1").alias("b")).distinct()
    links = stored(_verified(stored(stars, "line-stars"), classes, docs, similarity), "line-star-links")
    groups = components(links, "line-groups")

    # members that the smallest one did not gather: against all of other groups
    label = groups.select(F.col("id.h1").alias("h1"), F.col("comp").alias("comp"))
    left = posts.join(label, "h1", "left").select("bucket", "h1", "sim", "p1", F.coalesce(F.col("comp.h1"), F.col("h1")).alias("comp"))
    x, y = left.alias("x"), left.alias("y")
    rest = x.join(y, F.expr(f"x.bucket = y.bucket and x.h1 < y.h1 and x.comp <> y.comp and x.h1 <> x.p1 and y.h1 <> y.p1 "
                            f"and bit_count(x.sim ^ y.sim) <= {BITS}")).select(F.col("x.h1").alias("a"), F.col("y.h1").alias("b")).distinct()
    rest = stored(rest, "line-rest")
    if not rest.isEmpty():
        links = links.union(_verified(rest, classes, docs, similarity))
        groups = components(links, "line-groups")

    ids = groups.select(F.col("id.h1").alias("h1"), F.col("id.h2").alias("h2"), "comp")
    joined = classes.join(ids, ["h1", "h2"], "left").where("n > 1 or comp is not null").select(
        "h1", "h2", "first", F.coalesce("comp", F.struct("h1", "h2")).alias("comp"))
    joined = stored(joined, "line-grouped")
    firsts = joined.groupBy("comp").agg(F.min("first").alias("first"))
    return lines, stored(joined.drop("first").join(firsts, "comp").drop("comp"), "line-firsts")


def drop_repeated_lines(docs: DataFrame, min_words: int = 5, similarity: float = 0.9, min_letters: int = 12) -> DataFrame:
    """All columns of ``docs`` with the repeated lines cut from ``text``, plus
    n_lines and n_dropped (long).

    Lines end at line feeds. Lines of fewer than ``min_words`` words and of fewer
    than ``min_letters`` letters and digits always stay. A line may differ from its link by a tenth of its characters, at every
    length.
    Null texts stay null with no lines, empty ones stay empty with one line. A
    row repeated whole counts as the same place, so both stay or lose the same
    lines. Columns named like the operator's own (row, n_lines, n_dropped) are
    replaced by them or left out.
    """
    lines, firsts = fuzzy_line_groups(docs, min_words, similarity, min_letters)
    again = lines.join(firsts, ["h1", "h2"]).where("row <> first.row or line_no <> first.line_no")
    drops = stored(again.groupBy("row").agg(F.collect_set("line_no").alias("drops")), "line-drops")
    own = {"row", "drops", "n_lines", "n_dropped", "kept"}
    kept = [c for c in docs.columns if c.lower() not in own]
    parts = docs.select(*[F.col(f"`{c}`") for c in kept], F.xxhash64("doc_id", "text").alias("row"))
    # only rows that a bitmap of those with repeated lines lets through are moved
    held, whole = split_by_bloom(parts, "row", drops, "line-drops-bloom")
    parts = held.join(drops, "row", "left").unionByName(whole, allowMissingColumns=True)
    cut = F.expr("case when drops is null then text else array_join(filter(split(text, '\\n'), (x, i) -> not array_contains(drops, i)), '\\n') end")
    return parts.select(
        *[cut.alias("text") if c == "text" else F.col(f"`{c}`") for c in kept],
        F.coalesce(F.size(F.split("text", "\n")), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("drops"), F.lit(0)).cast("long").alias("n_dropped"))
