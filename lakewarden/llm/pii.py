"""Personal data: fixed patterns, and terms whose co-occurrence gives protected values away.

Email addresses, IP addresses, card and phone numbers are found by pattern. Each value found is an
entity to protect, and so is what values share: the name and the domain of an address, the first two
and three numbers of an IP, the first four digits of a phone number and six of a card. A term of its
context discloses an entity as far as the corpus ties the two together: with n documents, n_e holding
the entity, n_t holding the term and n_et holding both nearby,

    PMI = log(n * n_et / (n_e * n_t)),    IC = log(n / n_e),    disclosure = PMI / IC.

At 1 the term occurs with the entity only and tells as much as the entity itself. Terms at ``REMOVE``
or more are removed and terms at ``GENERALISE`` or more become a placeholder, in all documents that
hold them. So that a common word is left alone where it does not point at the entity, at least
``REMOVE_SHARE`` or ``GENERALISE_SHARE`` of the documents with the term must hold the entity nearby.

Co-occurrence is evidence where chance alone does not explain it: with k pieces of evidence and
mu = n_e * n_t / n, chance gives k or more with a probability below exp(k - mu - k * log(k / mu))
(Chernoff), which must not exceed ``CHANCE`` over all pairs looked at. Near copies of one text are one
piece: for what values share, each value counts once; for a value, its texts count unless their
contexts are copies, that is share ``OVERLAP`` of their terms or more and have ``PASSAGE`` or more. Fewer than ``EVIDENCE`` pieces
tie nothing.

Everything is a Spark expression. The patterns take possessive quantifiers and start where a run of
their first characters starts or the last match ended, which changes no match but keeps the time
linear in the length of any text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakewarden.llm.common import saved, table
from lakewarden.operators.matching import narrowed

_LOCAL = "A-Za-z0-9._%+-"
PATTERNS = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Stands for nothing in any pattern; set around matches to cut them out.
MARK, STAND_IN = "\ue000", "\x01"
_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
#: Runs of three letters or more, and shorter ones of scripts that write words in one or two.
TERM = r"\p{L}{3,}|(?<!\p{L})[\p{IsHan}\p{IsHangul}\p{IsHiragana}\p{IsKatakana}]{1,2}(?!\p{L})"
#: Characters before and after an entity that are its context.
REACH = 300
#: Chance that any of the pairs looked at passes for tied, though it is not.
CHANCE = 0.05
GENERALISE, REMOVE = 0.7, 0.9
#: Share of a term's documents that hold the entity nearby.
GENERALISE_SHARE, REMOVE_SHARE = 0.75, 0.85
EVIDENCE = 3
#: Share of a context's terms found in another of the same value, on average, from which they are copies,
#: and terms of a context from which that can be told: shorter ones may share a set phrase.
OVERLAP, PASSAGE = 0.5, 20
CHUNK = 256
SPAN = "array<struct<start:bigint,end:bigint,value:string>>"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once; used as it is, it would be computed at each place."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _sum(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0).cast("bigint"), lambda total, x: total + x)


def _ends(lengths: Column) -> Column:
    """Running sums of an array of bigints, chunk by chunk, in time that stays near linear."""
    numbers = F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / CHUNK).cast("int"))

    def within(start: Column, chunk: Column) -> Column:
        sums = F.aggregate(chunk, F.array(start), lambda done, x: F.concat(done, F.array(F.element_at(done, -1) + x)))
        return F.slice(sums, F.lit(2), F.size(chunk))

    def joined(sums: Column) -> Column:
        return F.flatten(F.transform(numbers, lambda c: within(_sum(F.slice(sums, F.lit(1), c)), F.slice(lengths, c * CHUNK + 1, F.lit(CHUNK)))))

    return _let(F.transform(numbers, lambda c: _sum(F.slice(lengths, c * CHUNK + 1, F.lit(CHUNK)))), joined)


def spans_of(text: Column, pattern: str | Column) -> Column:
    """Start, end and text of each match, in characters from 0, end exclusive."""
    if isinstance(pattern, str):
        pattern = F.lit(pattern)

    def found(pieces: Column, ends: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(1), F.size(pieces) - 2, F.lit(2)),
            lambda i: F.struct(F.get(ends, i - 1).alias("start"), F.get(ends, i).alias("end"), F.get(pieces, i).alias("value")),
        )

    def placed(pieces: Column) -> Column:
        lengths = F.transform(pieces, lambda p: F.char_length(p).cast("bigint"))
        return _let(_let(lengths, _ends), lambda ends: found(pieces, ends))

    pieces = F.split(F.regexp_replace(text, pattern, F.lit(f"{MARK}$0{MARK}")), MARK, -1)
    return F.when(F.regexp_like(text, pattern), _let(pieces, placed)).otherwise(F.array().cast(SPAN))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def add(total: Column, i: Column) -> Column:
        digit = F.substring(digits, F.length(digits) - i + 1, F.lit(1)).cast("int")
        return total + F.when(i % 2 == 1, digit).otherwise(2 * digit - F.when(digit > 4, 9).otherwise(0))

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    return {
        "email": lambda: F.lit(True),
        "ip": lambda: value.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"),
        "card": lambda: _let(_digits(value), lambda d: F.when(F.length(d).between(13, 19), _luhn(d)).otherwise(False)),
        "phone": lambda: F.length(_digits(value)).between(9, 15),
    }[kind]()


def base_spans(text: Column) -> list[Column]:
    """One column of spans per kind; matches that fail their kind's test are dropped."""

    def kept(kind: str) -> Column:
        return F.filter(spans_of(text, PATTERNS[kind]), lambda s: _valid(kind, s["value"]))

    return [kept(kind).alias(kind) for kind in PATTERNS]


def _key() -> Column:
    """Two 64-bit hashes of a row's id and text."""
    return F.struct(F.xxhash64("doc_id", "text").alias("a"), F.xxhash64(F.lit("row"), "doc_id", "text").alias("b"))


def _plain(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), MARK, STAND_IN)


def _found(docs: DataFrame, *columns: str) -> DataFrame:
    """row (the given columns), key, spans of each kind; the text only of rows that have any."""
    row = F.struct(*[docs[c] for c in columns]).alias("row")
    read = docs.select(row, _key().alias("key"), _plain(F.col("text")).alias("text"))
    spans = read.select("row", "key", "text", *base_spans(F.col("text")))
    number = sum((F.size(k) for k in PATTERNS), F.lit(0))
    return spans.withColumn("text", F.when(number > 0, F.col("text")))


def _terms(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(f"({TERM})"), 1))


def _context(text: Column, start: Column, end: Column) -> Column:
    """The whole words within reach of a span."""
    begin = F.greatest(start - REACH, F.lit(0))
    before = F.substring(text, (begin + 1).cast("int"), (start - begin).cast("int"))
    before = F.when(begin > 0, F.regexp_replace(before, r"^\p{L}+", "")).otherwise(before)
    after = F.substring(text, (end + 1).cast("int"), F.lit(REACH))
    after = F.when(F.char_length(after) == REACH, F.regexp_replace(after, r"\p{L}+$", "")).otherwise(after)
    return F.concat(before, F.lit(" "), after)


def _entities(kind: str, value: Column) -> Column:
    """The names of a value and of what it shares with others of its kind."""
    digits = _digits(value)
    parts = {
        "email": {"email": value, "name": F.split_part(value, F.lit("@"), F.lit(1)), "domain": F.split_part(value, F.lit("@"), F.lit(2))},
        "ip": {"ip": value, "net3": F.substring_index(value, ".", 3), "net2": F.substring_index(value, ".", 2)},
        "card": {"card": value, "issuer": F.substring(digits, 1, 6)},
        "phone": {"phone": value, "area": F.substring(digits, 1, 4)},
    }[kind]
    return F.array(*[F.concat(F.lit(f"{name}:"), F.lower(part)) for name, part in parts.items()])


def _pairs(found: DataFrame) -> DataFrame:
    """entity, term, n_e, n_et, units: the pairs that stand near each other, and their pieces of evidence.

    Rows that repeat id and text are documents of their own. Only entities of two texts or more count.
    """

    def entities_of(kind: str) -> Column:
        return F.transform(kind, lambda s: F.struct(_entities(kind, s["value"]).alias("entities"), s["start"].alias("start"), s["end"].alias("end")))

    every = F.concat(*map(entities_of, PATTERNS))
    holding = found.where(F.col("text").isNotNull()).withColumn("copy", F.xxhash64("text"))
    at = holding.select("key", "copy", "text", F.explode(every).alias("s"))
    near = _terms(_context(F.col("text"), F.col("s.start"), F.col("s.end"))).alias("near")
    at = at.select("key", "copy", F.xxhash64(F.get("s.entities", F.lit(0))).alias("value"), F.explode("s.entities").alias("entity"), near)
    at = saved(at, "entities")
    rows = saved(holding.groupBy("key").agg(F.count("*").alias("rows")), "holding-rows")
    copies = at.select("entity", "copy", "key").distinct().join(rows, "key").groupBy("entity", "copy").agg(F.sum("rows").alias("n"))
    n_e = copies.groupBy("entity").agg(F.sum("n").alias("n_e"), F.count("*").alias("k"))
    n_e = saved(n_e.where(F.col("k") > 1), "shared-entities")
    near = at.join(n_e, "entity").select("entity", "copy", "key", "value", F.explode("near").alias("term"))
    near = near.groupBy("entity", "term", "copy", "key").agg(F.min("value").alias("value"))
    texts = near.join(rows, "key").groupBy("entity", "term", "copy").agg(F.sum("rows").alias("n"), F.min("value").alias("value"))
    values = texts.groupBy("entity", "term", "value").agg(F.sum("n").alias("n"), F.count("*").alias("texts"))
    pairs = values.groupBy("entity", "term").agg(F.sum("n").alias("n_et"), F.sum("texts").alias("texts"), F.count("*").alias("values"))
    pairs = saved(pairs, "entity-terms")
    # Of a context's terms, how many another context of the entity holds: a share of ``places``.
    again = F.sum(F.col("texts") * (F.col("texts") - 1))
    shared = pairs.groupBy("entity").agg(again.alias("again"), F.sum("texts").alias("places")).join(n_e, "entity")
    copied = (F.col("again") >= OVERLAP * F.col("places") * (F.col("k") - 1)) & (F.col("places") >= PASSAGE * F.col("k"))
    literal = F.substring_index("entity", ":", 1).isin(*PATTERNS)
    units = F.when(~literal, F.col("values")).when(copied, F.lit(1)).otherwise(F.col("texts"))
    return pairs.join(shared, "entity").select("entity", "term", "n_e", "n_et", units.alias("units"))


def telling_terms(docs: DataFrame, found: DataFrame) -> DataFrame:
    """term, action: the terms that disclose an entity. ``found`` is the stored result of the pattern search.

    Document counts of terms are over all words of all documents; both they and the pairs are combined
    in map tasks.
    """
    pairs = saved(_pairs(found), "evidence")
    enough = pairs.where(F.col("units") >= EVIDENCE)
    nothing = docs.sparkSession.createDataFrame([], "term string, action string")
    if enough.isEmpty():
        return nothing
    n, looked_at = float(max(docs.count(), 1)), max(pairs.count(), 1)
    words = docs.select(F.explode(_terms(F.col("text"))).alias("term")).groupBy("term").agg(F.count("*").alias("n_t"))
    tied = enough.join(words, "term")
    expected = F.col("n_e") * F.col("n_t") / n
    disclosure = F.log(F.col("n_et") / expected) / F.log((n + 1.0) / F.col("n_e"))
    surprise = F.col("units") * F.log(F.col("units") / expected) - F.col("units") + expected
    sure = (F.col("units") > expected) & (surprise >= F.log(F.lit(looked_at / CHANCE)))
    share = F.col("n_et") / F.col("n_t")
    action = F.when((disclosure >= REMOVE) & (share >= REMOVE_SHARE), "remove")
    action = action.when((disclosure >= GENERALISE) & (share >= GENERALISE_SHARE), "generalise")
    # Of two actions on a term, removal counts: it is the larger name.
    telling = tied.where(sure).groupBy("term").agg(F.max(action).alias("action")).where(F.col("action").isNotNull())
    return saved(telling, "disclosing-terms")


def with_term_spans(docs: DataFrame, found: DataFrame, telling: DataFrame) -> DataFrame:
    """``found`` with columns ``generalise`` and ``remove``: spans of the terms to act on.

    A term within a span of a pattern is part of it and not listed again. ``found`` has no text where no
    pattern matched; it comes from ``docs`` where a term does.
    """
    if telling.isEmpty():
        return found.select("*", *[F.array().cast(SPAN).alias(action) for action in ("generalise", "remove")])
    text = _plain(F.col("text"))
    own = docs.select(_key().alias("key"), F.explode(_terms(text)).alias("term")).join(telling, "term").distinct()
    terms = own.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("term", "action"))).alias("terms"))
    terms = saved(terms, "document-terms")
    bare = saved(found.where(F.col("text").isNull()).select("key").join(terms, "key", "left_semi").distinct(), "bare-rows")
    texts = narrowed(docs.select(_key().alias("key"), text.alias("_text")), "key", bare)
    texts = texts.join(bare, "key", "left_semi").dropDuplicates(["key"])
    joined = found.join(terms, "key", "left").join(saved(texts, "texts-with-terms"), "key", "left")
    joined = joined.withColumn("text", F.coalesce("text", "_text")).drop("_text")

    def pattern(action: str) -> Column:
        own = F.transform(F.filter("terms", lambda t: t["action"] == action), lambda t: t["term"])
        return F.concat(F.lit(r"(?iu)(?<!\p{L})(?:"), F.array_join(own, "|"), F.lit(r")(?!\p{L})"))

    taken = F.concat(*[F.col(k) for k in PATTERNS])

    def acted(action: str) -> Column:
        has = F.exists("terms", lambda t: t["action"] == action)
        found = spans_of(F.col("text"), pattern(action))
        spans = _let(taken, lambda t: F.filter(found, lambda s: ~F.exists(t, lambda b: (s["start"] < b["end"]) & (b["start"] < s["end"]))))
        return F.when(has, spans).otherwise(F.array().cast(SPAN)).alias(action)

    return joined.select("*", acted("generalise"), acted("remove"))


def _listed(kind: str) -> Column:
    return F.transform(kind, lambda s: F.concat_ws(":", F.lit(kind), s["start"].cast("string"), s["end"].cast("string")))


def find_personal_data(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): counts per kind, base_sha256, spans, n_spans (of all kinds).

    A null text is empty. Rows are told apart by id and text; rows that repeat both count as
    documents of their own and get the same result.
    """
    found = saved(_found(docs, "doc_id"), "pattern-spans")
    spans = with_term_spans(docs, found, telling_terms(docs, found))
    base = F.array_join(F.concat(*[_listed(k) for k in PATTERNS]), ",")
    every = F.array_join(F.concat(*[_listed(k) for k in (*PATTERNS, "generalise", "remove")]), ",")
    counts = [F.size(k).cast("bigint").alias(f"n_{k}") for k in PATTERNS]
    number = sum((F.size(k) for k in (*PATTERNS, "generalise", "remove")), F.lit(0)).cast("bigint")
    row_id = F.col("row.doc_id").cast("bigint").alias("doc_id")
    return spans.select(row_id, *counts, F.sha2(base, 256).alias("base_sha256"), every.alias("spans"), number.alias("n_spans"))


def _rewritten(text: Column) -> Column:
    """The text with a placeholder for each span; of overlapping spans the first has its way."""
    tags = {k: f"[{k.upper()}]" for k in PATTERNS} | {"generalise": "[TERM]", "remove": ""}

    def tagged(kind: str) -> Column:
        return F.transform(kind, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(tags[kind]).alias("tag")))

    def replaced(spans: Column) -> Column:
        def done(i: Column) -> Column:
            return F.coalesce(F.array_max(F.transform(F.slice(spans, F.lit(1), i), lambda s: s["end"])), F.lit(0).cast("bigint"))

        def part(s: Column, i: Column) -> Column:
            gap = F.substring(text, (done(i) + 1).cast("int"), (s["start"] - done(i)).cast("int"))
            return F.when(s["start"] >= done(i), F.concat(gap, s["tag"])).otherwise("")

        rest = F.substring(text, (done(F.size(spans)) + 1).cast("int"), F.char_length(text))
        return F.concat(F.array_join(F.transform(spans, part), ""), rest)

    return _let(F.array_sort(F.concat(*map(tagged, tags))), replaced)


def sanitize(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data and disclosing terms replaced; rows without any are unchanged.

    Other columns stay as they are, whatever their names, ``n_chars`` included if there is one. The rows
    are stored with their spans, so that nothing has to be joined to them but the terms of those that
    hold any.
    """
    found = saved(_found(docs, *docs.columns), "pattern-spans")
    spans = with_term_spans(docs, found, telling_terms(docs, found))
    # Places count characters, so they hold for the text as it was read.
    text = F.col("row").getField("text")
    number = sum((F.size(k) for k in (*PATTERNS, "generalise", "remove")), F.lit(0))
    new = F.when(number > 0, _rewritten(text)).otherwise(text).alias("text")
    return spans.select(*[new if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns])


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data and disclosing terms in all documents."""
    return find_personal_data(table(spark, sf_dir, "documents"))


_SQL_CUT = r"""
    SELECT row, {place} AS place, string_split(regexp_replace(text, '({pattern})', chr(57344) || '\1' || chr(57344), 'g'), chr(57344)) AS pieces
    FROM texts"""
_SQL_PATTERNS = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)
#: The base kinds. SQL knows no terms: where the tables tie some to values, ``spans`` and ``n_spans`` differ.
OP5_SQL = rf"""
WITH
texts AS (
    SELECT row_number() OVER () AS row, doc_id, replace(coalesce(text, ''), chr(57344), chr(1)) AS text FROM documents
),
-- Every other piece is a match.
cut AS ({" UNION ALL".join(_SQL_CUT.format(place=place, pattern=pattern) for place, pattern in enumerate(_SQL_PATTERNS))}
),
pieces AS (
    SELECT row, place, unnest(pieces) AS value, unnest(range(1, len(pieces) + 1)) AS i FROM cut WHERE len(pieces) > 1
),
placed AS (
    SELECT row, place, value, i, CAST(sum(length(value)) OVER (PARTITION BY row, place ORDER BY i) AS BIGINT) AS stop FROM pieces
),
matches AS (
    SELECT row, place, value, stop - length(value) AS start, stop, regexp_replace(value, '[^0-9]', '', 'g') AS digits
    FROM placed WHERE i % 2 = 0
),
valid AS (
    SELECT row, place, start, stop, ['email', 'ip', 'card', 'phone'][place + 1] || ':' || start || ':' || stop AS span FROM matches
    WHERE CASE place
        WHEN 0 THEN TRUE
        WHEN 1 THEN len(list_filter(string_split(value, '.'), lambda x: length(ltrim(x, '0')) > 3 OR coalesce(TRY_CAST(ltrim(x, '0') AS INT), 0) > 255)) = 0
        WHEN 2 THEN length(digits) BETWEEN 13 AND 19 AND list_sum(list_transform(
            list_reverse(string_split(digits, '')),
            lambda x, i: CASE WHEN i % 2 = 1 THEN CAST(x AS INT) ELSE CAST(x AS INT) * 2 - CASE WHEN CAST(x AS INT) > 4 THEN 9 ELSE 0 END END)) % 10 = 0
        ELSE length(digits) BETWEEN 9 AND 15 END
),
listed AS (
    SELECT row, count(*) FILTER (WHERE place = 0) AS n_email, count(*) FILTER (WHERE place = 1) AS n_ip,
           count(*) FILTER (WHERE place = 2) AS n_card, count(*) FILTER (WHERE place = 3) AS n_phone, count(*) AS n_spans,
           string_agg(span, ',' ORDER BY place, start) AS spans
    FROM valid GROUP BY row
)
SELECT doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card, coalesce(n_phone, 0) AS n_phone,
       sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_spans, 0) AS n_spans
FROM texts LEFT JOIN listed USING (row)
"""
