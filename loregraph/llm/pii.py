"""Personal data: regular expressions propose spans, checksums confirm them, context words score them.

Built from SQL functions only, so a text never leaves the JVM, and nothing is shuffled. Positions come
from the pieces between matches: ``split`` on the same pattern gives one piece more than matches.

Patterns are written with possessive quantifiers and look-behinds. They match what the plain forms in
the comments match, without the plain forms' recursion and without a new scan of a long run from each
of its characters. Account numbers are the exception: they have their country's length, and a match takes
in their first two letters only, so that neither what follows nor another candidate before is in the way.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Kind:
    """``plain``: the pattern as SQL engines without look-behind can run it. ``gate``: a text without
    this character can't match. ``context``: words that make a span likelier, within ``NEAR``. ``takes``:
    if given, the span is the pattern's first group, and the match itself has so many characters."""

    name: str
    pattern: str
    plain: str
    gate: str | None
    context: str
    base: bool = True
    takes: int | None = None


#: Code points on either side of a span that are searched for context words.
NEAR = 48
#: Matches whose places are added up in one go; and code points of a block, into which texts of more than twice
#: as many bytes are cut, so that the surroundings of a span are found without counting from the text's start.
RUN, PIECE = 512, 4096
#: A span of a kind with checksum or fixed form starts at 60, one without at 40; a context word adds 35.
SURE, OPEN, NEARBY = 60, 40, 35
#: Kinds that the method adds need so much.
NEEDED = 60

# Length of account numbers by country. Where a country isn't listed any length may do.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
_FIXED = [f"(?:{names.replace(' ', '|')})[0-9]{{2}}(?:\\x20?[A-Z0-9]){{{n - 4}}}(?![A-Za-z0-9])" for n, names in IBAN_LENGTHS.items()]
_OTHER = rf"(?!{'|'.join(IBAN_LENGTHS.values()).replace(' ', '|')})[A-Z]{{2}}[0-9]{{2}}(?:\x20?[A-Z0-9]){{11,30}}+(?![A-Za-z0-9])"
_IBAN = rf"(?<![A-Za-z0-9])(?=[A-Z]{{2}}[0-9]{{2}})(?=({'|'.join([*_FIXED, _OTHER])}))[A-Z]{{2}}"

# Kinds in the order in which spans are listed.
KINDS = (
    Kind("email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "@", "mail|contact|write|kontakt|correo|courriel"),
    Kind("ip", r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+", ".", "ip|server|host|address|login"),
    Kind("card", r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,18}+(?![\x20-]?[0-9])", r"[0-9](?:[\x20-]?[0-9])+", None, "card|credit|visa|master|amex|karte|carte|tarjeta"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9][\x20().0-9-]+[0-9]", "+", "phone|tel|call|mobile|fax|anruf|llame"),
    Kind("iban", _IBAN, r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}", None, "iban|bank|account|konto|compte|cuenta", base=False, takes=2),
    Kind("ssn", r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])", r"[0-9]{3}-[0-9]{2}-[0-9]{4}", "-", "ssn|social|security|tax", base=False),
)


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """From the right every second digit is doubled, less 9 if above 9; the sum is divisible by 10."""
    figures = F.transform(F.split(F.reverse(digits), ""), lambda c: c.cast("int"))
    value = lambda d, i: F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d)
    return F.aggregate(F.filter(F.transform(figures, value), lambda x: x.isNotNull()), F.lit(0), lambda a, x: a + x) % 10 == 0


def mod97(account: Column) -> Column:
    """The first four characters go to the end, letters count 10 to 35; the number is 1 modulo 97."""
    bare = F.replace(account, F.lit(" "), F.lit(""))
    turned = F.filter(F.split(F.concat(F.substr(bare, F.lit(5)), F.substr(bare, F.lit(1), F.lit(4))), ""), lambda c: c != "")
    step = lambda a, c: F.when(c.rlike("[0-9]"), (a * 10 + c.cast("int")) % 97).otherwise((a * 100 + F.ascii(c) - 55) % 97)
    return F.length(bare).between(15, 34) & (F.aggregate(turned, F.lit(0), step) == 1)


def _confirmed(kind: str, match: Column) -> Column:
    digits = _digits(match)
    return {
        "email": F.lit(True),
        "ip": match.rlike(r"^0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})(?:\.0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})){3}$"),
        "card": F.length(digits).between(13, 19) & luhn(digits),
        "phone": F.length(digits).between(9, 15),
        "iban": mod97(match),
        "ssn": ~match.rlike("^(?:000|666|9)|-00-|-0000$"),
    }[kind]


def _empty(kind: str) -> Column:
    return F.expr(f"cast(array() as array<{kind}>)")


def _placed(pairs: Column, takes: int | None) -> Column:
    """array<struct<start, stop, m>> from ``pairs`` (gap: characters since the match before, m). Places are
    added up within runs of ``RUN`` matches and then over the runs, as appending to one long array would
    copy it each time."""
    step = lambda x: F.lit(takes) if takes else F.length(x["m"])
    start = lambda kind: F.struct(F.lit(0).alias("at"), _empty(kind).alias("out"))
    one = "struct<start:int,stop:int,m:string>"

    def within(run: Column) -> Column:
        return F.aggregate(
            F.slice(pairs, run * RUN + 1, RUN), start(one),
            lambda a, x: F.struct((a["at"] + x["gap"] + step(x)).alias("at"), F.array_append(a["out"], F.struct((a["at"] + x["gap"]).alias("start"), (a["at"] + x["gap"] + F.length(x["m"])).alias("stop"), x["m"].alias("m"))).alias("out")),
        )

    moved = lambda a, r: F.transform(r["out"], lambda s: F.struct((a["at"] + s["start"]).alias("start"), (a["at"] + s["stop"]).alias("stop"), s["m"].alias("m")))
    runs = F.transform(F.sequence(F.lit(0), F.floor((F.size(pairs) - 1) / RUN).cast("int")), within)
    joined = F.aggregate(runs, start(f"array<{one}>"), lambda a, r: F.struct((a["at"] + r["at"]).alias("at"), F.array_append(a["out"], moved(a, r)).alias("out")), lambda a: F.flatten(a["out"]))
    return F.when(F.size(pairs) > 0, joined).otherwise(_empty(one))


def _pieces(text: Column) -> Column:
    """A long text in blocks of ``PIECE`` code points; null for others, whose start is near enough."""
    return F.when(F.octet_length(text) > 2 * PIECE, F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0)))


def _spans(text: Column, pieces: Column, k: Kind) -> Column:
    """array<struct<kind, start, end, score>> of the confirmed spans of one kind, in order."""
    matches = F.regexp_extract_all(text, F.lit(k.pattern), F.lit(1 if k.takes else 0))
    gaps = F.split(text, k.pattern, -1)
    # The last gap has no match.
    placed = _placed(F.filter(F.zip_with(matches, gaps, lambda m, g: F.struct(F.length(g).alias("gap"), m.alias("m"))), lambda x: x["m"].isNotNull()), k.takes)

    def part(at: Column, count: Column) -> Column:
        """``count`` characters, ``NEAR`` at most, from place ``at`` (from 0)."""
        block = F.floor(at / PIECE).cast("int")
        two = F.concat(F.coalesce(F.get(pieces, block), F.lit("")), F.coalesce(F.get(pieces, block + 1), F.lit("")))
        return F.when(pieces.isNull(), F.substr(text, at + 1, count)).otherwise(F.substr(two, at - block * PIECE + 1, count))

    near = lambda s: F.lower(F.concat(part(F.greatest(s["start"] - NEAR, F.lit(0)), F.least(s["start"], F.lit(NEAR))), F.lit(" "), part(s["stop"], F.lit(NEAR))))
    points = lambda s: F.lit(OPEN if k.name in ("ssn", "phone") else SURE) + F.when(near(s).rlike(f"(?:^|[^a-z])(?:{k.context})"), NEARBY).otherwise(0)
    found = F.transform(
        F.filter(placed, lambda s: _confirmed(k.name, s["m"])),
        lambda s: F.struct(F.lit(k.name).alias("kind"), s["start"].alias("start"), s["stop"].alias("end"), points(s).alias("score")),
    )
    if not k.base:
        found = F.filter(found, lambda s: s["score"] >= NEEDED)
    gate = F.contains(text, F.lit(k.gate)) if k.gate else text.rlike("[0-9]{2}|[0-9][ -][0-9]")
    return F.when(gate, found).otherwise(_empty("struct<kind:string,start:int,end:int,score:int>"))


def find_pii(docs: DataFrame, text: str = "text", into: str = "pii") -> DataFrame:
    """``docs`` with ``into``: array<struct<kind, start, end, score>>, by kind in listed order, then start;
    code points, end exclusive. Null and empty texts have none. All columns stay as they are, but one that
    is named ``into``, which is replaced, as ``withColumn`` does. An empty table gives an empty result."""
    others = [c for c in docs.columns if c.lower() != into.lower()]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in others]).alias("row"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("whole"))
    cut = rows.withColumn("pieces", _pieces(F.col("whole")))
    return cut.select("row.*", F.concat(*[_spans(F.col("whole"), F.col("pieces"), k) for k in KINDS]).alias(into))


def pii_report(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_email, n_ip, n_card, n_phone, base_sha256,
    spans, scores.

    Null text is empty. Null doc_id and repeated rows are reported like others. Empty table: empty result.
    """
    base = [k.name for k in KINDS if k.base]
    line = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    listed = lambda spans: F.array_join(F.transform(spans, line), ",")
    count = lambda kind: F.size(F.filter("pii", lambda s: s["kind"] == kind)).cast("long")
    pii = find_pii(docs.select("doc_id", "text")).select("doc_id", "pii")
    return pii.select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in base],
        F.sha2(listed(F.filter("pii", lambda s: s["kind"].isin(base))), 256).alias("base_sha256"),
        listed(F.col("pii")).alias("spans"),
        F.array_join(F.transform("pii", lambda s: s["score"].cast("string")), ",").alias("scores"),
    )


def sql() -> str:
    """The report in SQL. Engines without look-behind can't bound account and social security numbers the
    same way, so it lists the four base kinds; where a table holds neither, it gives every column."""
    valid = {
        "email": "true",
        "ip": "regexp_full_match(x.m, '0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})(?:\\.0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})){3}')",
        "card": "length(regexp_replace(x.m, '[^0-9]', '', 'g')) BETWEEN 13 AND 19 AND list_sum(list_transform(range(1, 1 + length(regexp_replace(x.m, '[^0-9]', '', 'g'))), "
        "lambda i: CASE WHEN i % 2 = 1 THEN CAST(substr(reverse(regexp_replace(x.m, '[^0-9]', '', 'g')), i, 1) AS INTEGER) "
        "WHEN CAST(substr(reverse(regexp_replace(x.m, '[^0-9]', '', 'g')), i, 1) AS INTEGER) > 4 THEN 2 * CAST(substr(reverse(regexp_replace(x.m, '[^0-9]', '', 'g')), i, 1) AS INTEGER) - 9 "
        "ELSE 2 * CAST(substr(reverse(regexp_replace(x.m, '[^0-9]', '', 'g')), i, 1) AS INTEGER) END)) % 10 = 0",
        "phone": "length(regexp_replace(x.m, '[^0-9]', '', 'g')) BETWEEN 9 AND 15",
    }
    parts = []
    for k in (k for k in KINDS if k.base):
        start = "CAST(list_sum(list_transform(g[1:i], lambda y: length(y))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda y: length(y))), 0) AS INTEGER)"
        placed = f"list_transform(range(1, 1 + len(m)), lambda i: {{'kind': '{k.name}', 's': {start}, 'e': {start} + CAST(length(m[i]) AS INTEGER), 'm': m[i]}})"
        found = f"list_filter({placed}, lambda x: {valid[k.name]})"
        near = f"lower(substr(t, greatest(x.s - {NEAR}, 0) + 1, least(x.s, {NEAR})) || ' ' || substr(t, x.e + 1, {NEAR}))"
        score = f"{OPEN if k.name == 'phone' else SURE} + CASE WHEN regexp_matches({near}, '(?:^|[^a-z])(?:{k.context})') THEN {NEARBY} ELSE 0 END"
        parts.append(f"SELECT place, doc_id, t, list_transform({found}, lambda x: {{'line': x.kind || ':' || x.s || ':' || x.e, 'score': CAST({score} AS VARCHAR)}}) AS f FROM (SELECT place, doc_id, t, regexp_extract_all(t, '{k.plain}') AS m, string_split_regex(t, '{k.plain}') AS g FROM d)")
    names = [k.name for k in KINDS if k.base]
    with_ = ", ".join(f"k{i} AS ({p})" for i, p in enumerate(parts))
    joined = " JOIN ".join(["k0", *(f"k{i} USING (place)" for i in range(1, len(parts)))])
    every = "list_concat(list_concat(k0.f, k1.f), list_concat(k2.f, k3.f))"
    lines = f"array_to_string(list_transform({every}, lambda x: x.line), ',')"
    return (
        f"WITH d AS (SELECT row_number() OVER () AS place, doc_id, coalesce(text, '') AS t FROM documents), {with_} SELECT k0.doc_id, " + ", ".join(f"CAST(len(k{i}.f) AS BIGINT) AS n_{n}" for i, n in enumerate(names))
        + f", sha256({lines}) AS base_sha256, {lines} AS spans, array_to_string(list_transform({every}, lambda x: x.score), ',') AS scores FROM {joined}"
    )
