"""Personal data: plain patterns, and bootstrapped contextual extraction for what they miss.

Valid finds of the plain patterns are seed entities.  The words around every find and
around every other identifier-like token are its lexical patterns.  Identifier-like is a
token with a digit, or with a symbol between letters (``jane(at)corp``), of any length;
words of letters alone are not.  Patterns and instances form a graph; Spark scores it in
rounds: a pattern is worth the share of its instances that are known to be of a kind, an
instance what the good patterns around it say together.  Instances above the threshold
join the known ones in the next round, and their places become further spans.

Neighbouring words are taken whole, however long and however far away: the blank-separated
pieces of what lies between tokens, and the tokens themselves, digits taken as alike.

DataFrame functions only.  Texts are read once; places follow from the lengths of what
lies between matches, summed per document and kind.  All patterns are possessive where
they repeat, so they are linear in the text and need no deep stack.  Edges are made
distinct before any join; only patterns above the confidence limit are joined back.

Defined cases: NULL and empty texts have no spans; spans are in code points, end exclusive;
repeated rows are scanned alike, and each counts once in the output; an instance counts
once per pattern, however often it occurs; of kinds with equal scores the first listed is
taken; other columns of any name are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from vitrine.llm.common import drop_stored, sized, stored

KINDS = ("email", "ip", "card", "phone")
LEARNED = tuple(f"learned_{k}" for k in KINDS)
TOKEN, DOCUMENT = 8, 9  # numbers of identifier tokens and of the row every document has

LOCAL = "A-Za-z0-9._%+-"
LETTERS = r"A-Za-z0-9_\x80-\x{10FFFF}"
BLANKS = r" \t-\r"
PATTERNS = {
    # a run of local characters is entered at its start or where the last match ended
    "email": rf"(?:\G|(?<![{LOCAL}]))[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
# one look back rules out most places inside words; phones and addresses may follow a letter
MENTION = r"(?<![A-Za-z0-9_])(?:" + "|".join((
    rf"(?<![{LOCAL}])[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    PATTERNS["phone"],
    PATTERNS["ip"],
    r"(?<!-)[0-9](?:[ -]?[0-9])++(?![0-9A-Za-z_/-])",
    # runs of letters and digits with symbols between them
    rf"(?<![{LETTERS}])[{LETTERS}]++(?:[^{LETTERS}{BLANKS}]++[{LETTERS}]++)++",
    r"(?<!-)[A-Za-z_-]*+[0-9][A-Za-z0-9_/-]*+",
)) + rf")|{PATTERNS['phone']}|[0-9](?<![0-9][0-9])[0-9]*+(?:\.[0-9]++){{3}}"
# every mention has a digit, an @ or a symbol between two letters
HINT = rf"[0-9@]|[{LETTERS}][^{LETTERS}{BLANKS}]++[{LETTERS}]"


@dataclass(frozen=True)
class Bootstrap:
    """Limits of the learning rounds.

    ``support``: known instances a pattern needs; ``smoothing`` is added to its instances;
    ``pattern_limit`` and ``instance_limit`` are the least confidence of a pattern that is
    used and of an instance that is taken.
    """

    rounds: int = 3
    support: float = 3.0
    smoothing: float = 1.0
    pattern_limit: float = 0.6
    instance_limit: float = 0.7


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def add(total: Column, place: Column) -> Column:
        digit = F.substring(F.reverse(digits), place, F.lit(1)).cast("int")
        twice = digit * 2
        return total + F.when(place % 2 == 1, digit).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _valid(kind: str, text: Column) -> Column:
    """Whether a match of the plain pattern holds."""
    if kind == "ip":
        small = lambda p: (F.length(F.ltrim(p, F.lit("0"))) <= 3) & (p.substr(-3, 3).cast("int") <= 255)
        return F.forall(F.split(text, "[.]", -1), small)
    if kind == "card":
        size = F.length(_digits(text))
        return F.when(size.between(14, 19), _luhn(_digits(text))).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(_digits(text)).between(10, 15)
    return F.lit(True)


def _kind_of(text: Column) -> Column:
    """Number of the kind a mention is a valid example of; NULL if none."""
    whole = {k: f"^(?:{p})$" for k, p in PATTERNS.items()}
    return (
        F.when(text.rlike(whole["email"]), F.lit(0))
        .when(text.rlike(whole["phone"]) & _valid("phone", text), F.lit(3))
        .when(text.rlike(whole["ip"]) & _valid("ip", text), F.lit(1))
        .when(text.rlike(whole["card"]) & _valid("card", text), F.lit(2))
    )


def _shape(word: Column) -> Column:
    """Hash of a word in lower case, digits alike; NULL if there is none."""
    return F.when(word != "", F.xxhash64(F.translate(F.lower(word), "123456789", "000000000")))


def _items(text: Column) -> Column:
    """All matches of all kinds with the lengths of what lies before them, in order.

    Mentions also carry the first and the last two words of the gap before them; one more
    item closes the text.  A gap is read backwards for its last words, so only they are matched.
    """
    def gap(g: Column, words: bool) -> Column:
        none = F.lit(None).cast("string")
        back = F.reverse(F.regexp_extract(F.reverse(g), rf"^[{BLANKS}]*+[^{BLANKS}]++(?:[{BLANKS}]++[^{BLANKS}]++)?+", 0))
        head = F.regexp_extract(g, rf"^[{BLANKS}]*+([^{BLANKS}]++)", 1)
        return F.struct(
            F.length(g).alias("size"), (head if words else none).alias("head"), (back if words else none).alias("tail")
        )

    def zipped(pattern: str, number: int, words: bool) -> Column:
        gaps = F.split(text, pattern, -1)
        found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
        pairs = F.arrays_zip(F.transform(gaps, lambda g: gap(g, words)).alias("gap"), found.alias("match"))
        return F.transform(
            pairs if words else F.filter(pairs, lambda x: x["match"].isNotNull()),
            lambda x: F.struct(
                F.lit(number).alias("kind"), x["gap"]["size"].alias("gap"), x["gap"]["head"].alias("head"),
                x["gap"]["tail"].alias("tail"), x["match"].alias("match"),
            ),
        )

    empty = F.array().cast("array<struct<kind:int,gap:int,head:string,tail:string,match:string>>")
    number = text.rlike("[0-9]")
    needs = {"email": F.contains(text, F.lit("@")), "ip": number & F.contains(text, F.lit(".")), "card": number,
             "phone": F.contains(text, F.lit("+"))}
    parts = [F.when(needs[k], zipped(PATTERNS[k], i, False)).otherwise(empty) for i, k in enumerate(KINDS)]
    parts.append(F.when(text.rlike(HINT), zipped(MENTION, TOKEN, True)).otherwise(empty))
    none = F.lit(None).cast("string")
    parts.append(F.array(F.struct(
        F.lit(DOCUMENT).alias("kind"), F.lit(0).alias("gap"), none.alias("head"), none.alias("tail"),
        F.lit("").alias("match"),
    )))
    return F.concat(*parts)


def mentions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Stored table ``row, id, kind, start, stop, known, instance, patterns``.

    One row per valid plain find (kinds 0 to 3), per mention with a neighbour (8: ``known``
    is the kind it is a seed of) and per document (9).
    """
    text = F.coalesce(docs[text_col], F.lit(""))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), docs[id_col].alias("id"), text.alias("text"))
    items = rows.select("row", "id", F.posexplode(_items(F.col("text"))).alias("at", "x")).select("row", "id", "at", "x.*")
    words = F.split(F.col("tail"), rf"[{BLANKS}]++", -1)  # blanks may follow: the last piece is then empty
    words = F.filter(words, lambda w: w != "")
    items = items.select(
        "row", "id", "at", "kind", "gap", "match", _shape(F.col("head")).alias("first"),
        _shape(F.try_element_at(words, F.lit(-1))).alias("last"), _shape(F.try_element_at(words, F.lit(-2))).alias("second"),
        F.when(F.col("kind") == TOKEN, _shape(F.col("match"))).alias("own"),
    )
    order = Window.partitionBy("row", "kind").orderBy("at")
    size = F.coalesce(F.length("match"), F.lit(0))
    upto = F.sum(F.col("gap") + size).over(order.rowsBetween(Window.unboundedPreceding, 0))
    placed = items.select(
        "row", "id", "kind", "match", "first", "last", "second", "own",
        F.lag("own").over(order).alias("own1"), F.lag("own", 2).over(order).alias("own2"),
        F.lag("last").over(order).alias("last1"),
        F.lead(F.coalesce("first", "own")).over(order).alias("right"),
        (upto - size).alias("start"), upto.alias("stop"),
    ).filter(F.col("match").isNotNull())
    match, mention = F.col("match"), F.col("kind") == TOKEN
    left, right = F.coalesce("last", "own1"), F.col("right")
    before = F.when(F.col("last").isNotNull(), F.coalesce("second", "own1")).otherwise(F.coalesce("last1", "own2"))
    patterns = F.array_compact(F.array(
        F.when(left.isNotNull(), F.xxhash64(F.lit("left"), left)),
        F.when(before.isNotNull() & left.isNotNull(), F.xxhash64(F.lit("two"), before, left)),
        F.when(left.isNotNull() & right.isNotNull(), F.xxhash64(F.lit("around"), left, right)),
    ))
    good = F.col("kind") == DOCUMENT
    for number, kind in enumerate(KINDS):
        good |= (F.col("kind") == number) & _valid(kind, match)
    good |= mention & left.isNotNull()  # every pattern holds the word before
    return stored(
        placed.filter(good).select(
            "row", "id", "kind", "start", "stop", F.when(mention, _kind_of(match)).alias("known"),
            F.when(mention, F.xxhash64(F.lower("match"))).alias("instance"),
            F.when(mention, patterns).alias("patterns"),
        ),
        "mentions",
    )


def learn(found: DataFrame, limits: Bootstrap = Bootstrap()) -> DataFrame:
    """Stored table ``instance, kind``: instances that patterns say are of a kind."""
    tokens = found.filter(F.col("kind") == TOKEN)
    edges = stored(
        tokens.select("instance", "known", F.explode("patterns").alias("pattern"))
        .groupBy("pattern", "instance").agg(F.max("known").alias("known")),
        "edges",
    )
    seeds = edges.filter("known IS NOT NULL").select("instance", F.col("known").alias("kind")).distinct()
    seeds = stored(seeds.withColumn("score", F.lit(1.0)).withColumn("seed", F.lit(True)), "seeds")
    known = seeds
    sizes = edges.groupBy("pattern").agg(F.count("*").alias("n"))
    for _ in range(limits.rounds):
        hits = edges.join(known, "instance").groupBy("pattern", "kind").agg(F.sum("score").alias("hit"))
        good = (
            hits.filter(F.col("hit") >= limits.support).join(sizes, "pattern")
            .withColumn("worth", F.col("hit") / (F.col("n") + limits.smoothing))
            .filter(F.col("worth") >= limits.pattern_limit).select("pattern", "kind", "worth")
        )
        good = stored(good, "patterns")
        said = (
            edges.filter("known IS NULL").join(sized(good), "pattern").groupBy("instance", "kind")
            .agg((1 - F.exp(F.sum(F.ln(1 - F.least("worth", F.lit(0.999)))))).alias("score"))
            .filter(F.col("score") >= limits.instance_limit)
        )
        # the kind with the highest score, of equal ones the first listed
        best = said.groupBy("instance").agg(F.max_by(F.struct("kind", "score"), F.struct("score", -F.col("kind"))).alias("x"))
        # a score may round to that of a seed, so seeds are told apart by their flag
        new = best.select("instance", "x.kind", "x.score", F.lit(False).alias("seed"))
        after = stored(seeds.union(new), "known")
        drop_stored(good, *([] if known is seeds else [known]))
        known = after
    return stored(known.filter("NOT seed").select("instance", "kind"), "learned")


def find_personal_data(
    docs: DataFrame, limits: Bootstrap = Bootstrap(), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id_col, spans``: per row of ``docs`` an array of (start, kind, stop) by start, then kind.

    Kinds are ``KINDS`` for the plain patterns and ``LEARNED`` for what the contexts add.
    """
    found = mentions(docs, id_col, text_col)
    learned = learn(found, limits)
    plain = found.filter(F.col("kind") != TOKEN).select("row", "id", "kind", "start", "stop")
    more = (
        found.filter((F.col("kind") == TOKEN) & F.col("known").isNull()).drop("kind")
        .join(sized(learned), "instance")
        .select("row", "id", (F.col("kind") + len(KINDS)).alias("kind"), "start", "stop")
    )
    span = F.when(F.col("kind") != DOCUMENT, F.struct("start", "kind", "stop"))
    spans = plain.union(more).groupBy("row").agg(F.first("id").alias(id_col), F.sort_array(F.collect_list(span)).alias("s"))
    names = F.array(*[F.lit(k) for k in (*KINDS, *LEARNED)])
    return spans.select(
        id_col,
        F.transform(
            "s", lambda x: F.struct(x["start"].alias("start"), F.get(names, x["kind"]).alias("kind"), x["stop"].alias("stop"))
        ).alias("spans"),
    )


def spans_text(spans: Column) -> Column:
    """``kind:start:end`` of all spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")
