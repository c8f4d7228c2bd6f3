r"""Personal data: patterns, and information-theoretic sanitisation of the terms around them. DataFrame operations only.

KINDS are found by pattern; a match that fails its kind's check is dropped. SECRETS (keys, long hexadecimal digits)
are found besides. These are the protected entities. The method then asks how strongly a term reveals that an
entity is near: over all documents, a term's words within two words of an entity (`near`) against all its words
(`total`), the entities told apart by value. A term discloses from LEAST_VALUES different values on, when the share
near / total is SHARE or more and the pointwise mutual information of term and entity is BITS or more. Wherever such a
term stands in any text, near an entity that a pattern finds or not, its place becomes a span of kind `term`, unless it
shares characters with an entity. `sanitised` puts [KIND] in the place of every span: entities are generalised to their
kind, terms removed to [TERM].

The patterns are possessive and start where a run starts, so that long runs take linear time and no stack; they
find what the plain ones find. Counts are aggregated before they are shuffled; all words of all texts meet the
disclosing terms, and documents meet their spans, never texts.

Null text counts as empty: no spans. Repeated rows get equal results, and count each in the corpus statistics.
An empty table gives an empty one; other columns play no part, but `sanitised` hands them on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from floeframe.llm.common import ids_and_text, new_path, removed, written

#: kind: pattern
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9]){12,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "secret": r"(?:(?<![A-Za-z0-9])(?:AKIA[0-9A-Z]{16}|[0-9a-f]{32,}+)(?![A-Za-z0-9]))",
}
KINDS = ("email", "ip", "card", "phone")
#: Characters on each side of an entity in which its two neighbours are sought first; if they don't end there, in all the text.
SIDE = 80
LEAST_VALUES, SHARE, BITS = 5, 0.5, 6.0
TERM, OTHER = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]", r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
#: From a span's edge on: the rest of a word that the span cuts, then up to two words with any separators.
WORDS = rf"^({TERM}*+)({OTHER}++)({TERM}++)(?:({OTHER}++)({TERM}++))?"
#: Both words are there and end.
ENDED = rf"^{TERM}*+{OTHER}++{TERM}++{OTHER}++{TERM}++{OTHER}"


def digits(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def luhn(found: Column) -> Column:
    d = digits(found)

    def add(total: Column, i: Column) -> Column:
        x = F.substr(d, F.length(d) - i, F.lit(1)).cast("int")
        twice = F.when(x > 4, 2 * x - 9).otherwise(2 * x)
        return total + F.when(i % 2 == 1, twice).otherwise(x)

    return F.aggregate(F.sequence(F.lit(0), F.length(d) - 1), F.lit(0), add) % 10 == 0


def valid(kind: str, found: Column) -> Column:
    n = F.length(digits(found))
    if kind == "ip":
        return F.forall(F.split(found, r"\."), lambda part: (F.length(F.ltrim(F.lit("0"), part)) <= 3) & (F.substr(part, F.greatest(F.length(part) - 8, F.lit(1))).cast("int") <= 255))
    if kind == "card":
        return n.between(13, 19) & luhn(found)
    if kind == "phone":
        return n.between(9, 15)
    return F.lit(True)


NO_SPANS = "array<struct<start:int,end:int,found:string>>"


def once(x: Column, made) -> Column:
    """made(x), x computed once."""
    return F.get(F.transform(F.array(x), made), 0)


#: Values whose prefixes are taken together, and characters of a piece of text.
BLOCK, PIECE = 128, 256


def prefixes(values: Column, zero: Column, merge) -> Column:
    """Of each of values what merge makes of those before it. Blocks first, then within a block: BLOCK steps a value,
    where one pass that appends to its result would copy that each time."""
    fold = lambda held: F.aggregate(held, zero, merge)
    blocks = F.sequence(F.lit(0), F.floor((F.size(values) - 1) / BLOCK).cast("int"))

    def within(held: Column, bases: Column) -> Column:
        def of_block(b: Column) -> Column:
            some = F.slice(held, b * BLOCK + 1, F.lit(BLOCK))
            return once(some, lambda x: F.transform(x, lambda _, i: merge(F.get(bases, b), fold(F.slice(x, 1, i)))))

        return F.flatten(F.transform(blocks, of_block))

    def made(held: Column) -> Column:
        sums = F.transform(blocks, lambda b: fold(F.slice(held, b * BLOCK + 1, F.lit(BLOCK))))
        bases = once(sums, lambda each: F.transform(each, lambda _, i: fold(F.slice(each, 1, i))))
        return once(bases, lambda x: within(held, x))

    return F.when(F.size(values) > 0, once(values, made)).otherwise(F.slice(values, 1, 0))


def spans(kind: str, text: Column) -> Column:
    """(start, end, found) of each match that passes: places are sums of the lengths of gaps and matches."""
    pattern = PATTERNS[kind]
    add = lambda a, b: a + b

    def placed(pieces: Column) -> Column:
        lengths = F.transform(pieces, lambda x: F.length(x["gap"]) + F.length(x["found"]))
        begins = prefixes(lengths, F.lit(0), add)

        def span(x: Column, at: Column) -> Column:
            start = at + F.length(x["gap"])
            return F.struct(start.alias("start"), (start + F.length(x["found"])).alias("end"), x["found"].alias("found"))

        return F.zip_with(pieces, begins, span)

    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    # what follows the last match is no one's gap
    pieces = F.zip_with(F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found)), found, lambda g, f: F.struct(g.alias("gap"), f.alias("found")))
    passed = F.filter(once(pieces, placed), lambda s: valid(kind, s["found"]))
    return F.when(F.rlike(text, F.lit(pattern)), passed).otherwise(F.array()).cast(NO_SPANS)


def in_pieces(text: Column) -> Column:
    """A text as pieces of PIECE characters: what lies at a place is found without a walk from the text's begin."""
    return F.regexp_extract_all(text, F.lit("(?s).{1,%d}" % PIECE), F.lit(0))


def between(pieces: Column, start: Column, end: Column) -> Column:
    """Characters from start to end, exclusive, of a text in pieces."""
    first = F.floor(start / PIECE).cast("int")
    some = F.slice(pieces, first + 1, F.floor(end / PIECE).cast("int") - first + 1)
    return F.when(end > start, F.substr(F.array_join(some, ""), start - first * PIECE + 1, end - start)).otherwise("")


def two_words(short: Column, whole: Column) -> Column:
    """(word, its distance) of up to two words from a span's edge on; an absent word is empty. short: the start of whole."""
    groups = lambda side: F.array(*(F.regexp_extract(side, WORDS, k) for k in range(1, 6)))

    def placed(g: Column) -> Column:
        first = F.length(g[0]) + F.length(g[1])
        second = first + F.length(g[2]) + F.length(g[3])
        return F.array(F.struct(g[2].alias("word"), first.alias("at")), F.struct(g[4].alias("word"), second.alias("at")))

    side = once(short, lambda s: F.when(F.rlike(s, F.lit(ENDED)), s).otherwise(whole))
    return once(once(side, groups), placed)


def neighbours(text: Column, pieces: Column, span: Column) -> Column:
    """(term, start, end, value) of the two words before and the two after a span, or as many as there are."""
    first, size = F.greatest(span["start"] - SIDE, F.lit(0)), F.length(F.element_at(pieces, -1)) + (F.size(pieces) - 1) * PIECE
    before = two_words(F.reverse(between(pieces, first, span["start"])), F.reverse(F.substr(text, F.lit(1), span["start"])))
    after = two_words(between(pieces, span["end"], F.least(span["end"] + SIDE, size)), F.substr(text, span["end"] + 1))

    def row(word: Column, start: Column) -> Column:
        return F.struct(F.lower(word).alias("term"), start.alias("start"), (start + F.length(word)).alias("end"), F.xxhash64(span["found"]).alias("value"))

    b = F.transform(before, lambda w: row(F.reverse(w["word"]), span["start"] - w["at"] - F.length(w["word"])))
    a = F.transform(after, lambda w: row(w["word"], span["end"] + w["at"]))
    return F.filter(F.concat(b, a), lambda x: x["term"] != "")


def different(rows: Column) -> Column:
    """Each of an array's structs once: sorted, then those unlike the one before."""
    return once(F.array_sort(rows), lambda held: F.filter(held, lambda x, i: (i == 0) | (x != F.get(held, i - 1))))


def row_key() -> Column:
    """128 bits of a row's id and text, which stand for the row in joins."""
    of = [F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit(""))]
    return F.struct(F.xxhash64(*of).alias("a"), F.xxhash64(F.lit(1), *of).alias("b"))


def found(docs: DataFrame) -> DataFrame:
    """(row, doc_id, a column of spans for each kind, near) of every row of docs, written down: it holds no texts."""
    keyed = ids_and_text(docs).withColumn("row", row_key())
    each = keyed.select("row", "doc_id", "text", *(spans(kind, F.col("text")).alias(kind) for kind in PATTERNS))
    # explode of one array: else every mention of a result would find the spans anew
    held = each.select("row", "doc_id", "text", F.explode(F.array(F.struct(*PATTERNS))).alias("s"))
    every = F.concat(*(F.col("s")[kind] for kind in PATTERNS))
    around = lambda pieces: F.flatten(F.transform(every, lambda s: neighbours(F.col("text"), pieces, s)))
    near = F.when(F.size(every) > 0, different(once(in_pieces(F.col("text")), around)))
    return written(held.select("row", "doc_id", "s.*", near.alias("near")), "personal")


def disclosing(docs: DataFrame, spans_found: DataFrame) -> DataFrame:
    """(term, near, total, bits) of the terms that reveal an entity, written down: at most one for LEAST_VALUES entities."""
    each = ids_and_text(docs).select(F.explode(F.split(F.lower("text"), f"{OTHER}+")).alias("term")).where("term <> ''")
    path = new_path(docs.sparkSession, "terms")
    total = written(each.groupBy("term").agg(F.count("*").alias("total")), "terms", path)  # read for its sum and the join
    places = spans_found.select(F.explode("near").alias("n")).groupBy(F.col("n.term").alias("term"))
    near = places.agg(F.count("*").alias("near"), F.count_distinct("n.value").alias("values"))
    sums = total.agg(F.sum("total")).first()[0] or 0
    size = F.sum(F.when(F.col("near").isNotNull(), F.size("near")).otherwise(0))
    all_near = spans_found.agg(size).first()[0] or 0
    bits = F.log2(F.col("near") / F.col("total") * F.lit(float(sums)) / F.lit(float(max(all_near, 1))))
    told = near.where(F.col("values") >= LEAST_VALUES).join(total, "term").withColumn("bits", bits)
    told = told.where((F.col("near") >= SHARE * F.col("total")) & (F.col("bits") >= BITS))
    found = written(told.select("term", "near", "total", "bits"), "disclosing")
    removed(docs.sparkSession, path)
    return found


#: Words of a stretch: a word's place is its stretch's and the lengths of the words before it there.
STRETCH = 16


def places(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(row, term, start, end) of every place in docs where one of terms stands as a whole word, letters' case aside."""
    word = f"{OTHER}*+{TERM}++"
    all_of = lambda text, pattern: F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def begun(stretches: Column) -> Column:
        begins = prefixes(F.transform(stretches, F.length), F.lit(0), lambda a, b: a + b)
        return F.zip_with(stretches, begins, lambda x, at: F.struct(at.alias("at"), x.alias("part")))

    stretches = all_of(F.col("text"), f"(?:{word}){{1,{STRETCH}}}")
    cut = ids_and_text(docs).select(row_key().alias("row"), F.explode(once(stretches, begun)).alias("s")).select("row", "s.*")
    each = cut.select("row", "at", "part", F.posexplode(all_of(F.col("part"), f"{TERM}++")).alias("i", "word"))
    met = each.withColumn("term", F.lower("word")).join(terms.select("term"), "term")
    end = F.col("at") + F.length(F.array_join(F.slice(all_of(F.col("part"), word), F.lit(1), F.col("i") + 1), ""))
    return met.select("row", "term", (end - F.length("word")).alias("start"), end.alias("end"))


def apart(words: Column, entities: Column) -> Column:
    """Those of words that share no character with one of entities, sorted."""
    last = 2**31 - 1

    def marked(held: Column, word: bool) -> Column:
        return F.transform(held, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["found"].alias("found"), F.lit(word).alias("word")))

    def free(held: Column) -> Column:
        # the farthest end of the entities before, the nearest start of those behind
        ends = prefixes(F.transform(held, lambda s: F.when(s["word"], 0).otherwise(s["end"])), F.lit(0), lambda a, b: F.greatest(a, b))
        starts = F.transform(F.reverse(held), lambda s: F.when(s["word"], last).otherwise(s["start"]))
        starts = F.reverse(prefixes(starts, F.lit(last), lambda a, b: F.least(a, b)))
        alone = lambda e, b: F.filter(held, lambda s, i: s["word"] & (F.get(e, i) <= s["start"]) & (F.get(b, i) >= s["end"]))
        return once(ends, lambda e: once(starts, lambda b: alone(e, b)))

    kept = once(F.array_sort(F.concat(marked(words, True), marked(entities, False))), free)
    return F.transform(kept, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["found"].alias("found")))


def with_terms(docs: DataFrame) -> DataFrame:
    """What `found` gives, and in `term` the spans of disclosing terms, wherever they stand."""
    base = found(docs)
    hits = places(docs, disclosing(docs, base)).groupBy("row").agg(F.collect_set(F.struct("start", "end", F.col("term").alias("found"))).alias("term"))
    no_terms, entities = F.array().cast(NO_SPANS), F.concat(*PATTERNS)
    joined = base.drop("near").join(hits, "row", "left")
    return joined.withColumn("term", F.when(F.col("term").isNull(), no_terms).otherwise(apart(F.col("term"), entities)))


def _one(kind: str, shown):
    return lambda s: shown(kind, s)


def each_of(kinds, shown) -> Column:
    """shown(kind, span) of all spans, by kind as listed, then in their order."""
    return F.concat(*(F.transform(F.col(kind), _one(kind, shown)) for kind in kinds))


def listed(kinds) -> Column:
    return F.array_join(each_of(kinds, lambda kind, s: F.concat_ws(":", F.lit(kind), s["start"], s["end"])), ",")


def personal_data(docs: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) of every row of docs."""
    rows = with_terms(docs)
    counts = [F.size(kind).cast("long").alias(f"n_{kind}") for kind in KINDS]
    return rows.select("doc_id", *counts, F.sha2(listed(KINDS), 256).alias("base_sha256"), listed([*PATTERNS, "term"]).alias("spans"))


def covered(text: Column, places: Column) -> Column:
    """text with [KIND] for each of places (start, end, kind), sorted; of those that overlap the earlier one wins."""
    ends = F.transform(places, lambda p: p["end"])
    # a place is shown if none before it ends behind its start; what is between is kept
    since = prefixes(ends, F.lit(0), lambda a, b: F.greatest(a, b))
    label = lambda kind: F.concat(F.lit("["), F.upper(kind), F.lit("]"))

    def shown(pieces: Column) -> Column:
        each = F.zip_with(places, since, lambda p, at: F.when(p["start"] >= at, F.concat(between(pieces, at, p["start"]), label(p["kind"]))).otherwise(""))
        return F.concat(F.array_join(each, ""), F.substr(text, F.array_max(ends) + 1))

    return F.when(F.size(places) > 0, once(in_pieces(text), shown)).otherwise(text)


def sanitised(docs: DataFrame) -> DataFrame:
    """docs with its text column sanitised; a null text stays null. n_chars, if there, is the new length; all other columns stay."""
    kinds = [*PATTERNS, "term"]
    every = F.array_sort(each_of(kinds, lambda kind, s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(kind).alias("kind"))))
    places = with_terms(docs).select(F.col("row").alias("__row"), every.alias("__places")).where(F.size("__places") > 0).dropDuplicates(["__row"])
    keyed = docs.withColumn("__row", row_key())
    joined = keyed.join(places, "__row", "left")
    text = F.when(F.col("__places").isNull(), F.col("text")).otherwise(covered(F.col("text"), F.col("__places")))
    made = joined.withColumn("text", text)
    if "n_chars" in docs.columns:
        size = F.when(F.col("__places").isNull(), F.col("n_chars")).otherwise(F.length("text"))
        made = made.withColumn("n_chars", size.cast(docs.schema["n_chars"].dataType))
    return made.select(*docs.columns)
