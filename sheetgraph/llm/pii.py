"""Personal data: patterns propose spans, checksums confirm them, context words nearby adjust their score.

Everything is a Column expression over one row's text: no shuffle, no Python. A pattern's
matches and the text between them come from the same scan; their lengths summed up give the
places. Sums and running limits over the matches of a text are made by doubling steps, so a text
of k matches costs k log k. Patterns are possessive, and a word is entered at its first letter only,
so a text of any length is read in linear time and without deep recursion.

Two sorts of spans are found. Those of `BASE` count by their pattern and validator alone. Those of
`ADDED` need more: an `iban` its country's length and the remainder 1 of 97; a `tel` (a number
without country code) a word for a telephone near it; a `pan` (a card number of 12 or 13 digits, or
with other separators) Luhn's sum and a word for a card near it. A span's score is what its validator
gives, raised by a word of its kind in the text before or after it, up to the neighbouring candidate, and
lowered by a word that says that numbers there are something else; added spans need `threshold`.
`tel` and `pan` never overlap another span; an `iban` may overlap a card that is found by its digits.

Edge cases: a null or empty text has no spans; a null id is kept; texts of any length are read whole;
equal texts have equal spans; repeated rows give repeated results; an empty table gives an empty result; other
columns are kept, but `spans` is replaced. Spans of the same start go by kind as listed, then by end.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BASE = ("email", "ip", "card", "phone")
ADDED = ("iban", "tel", "pan")
KINDS = (*BASE, *ADDED)

_EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
_IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
_CARD = r"[0-9](?:[\x20-]?[0-9]){13,}+"  # shorter runs of digits can't pass
_PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_IBAN = r"[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)"
_NUMBER = r"[(]?[0-9](?:[\x20()./-]{0,2}[0-9]){6,}+"

#: Lengths of account numbers by country, as registered under ISO 13616.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BR": 29, "BY": 28, "CH": 21, "CR": 22, "CY": 28, "CZ": 24,
    "DE": 22, "DK": 18, "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18, "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28,
    "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IQ": 23, "IS": 26, "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LC": 32, "LI": 21, "LT": 20, "LU": 20,
    "LV": 21, "MC": 27, "MD": 24, "ME": 22, "MK": 19, "MR": 27, "MT": 31, "MU": 30, "NL": 18, "NO": 15, "PK": 24, "PL": 28, "PS": 29, "PT": 25, "QA": 29,
    "RO": 24, "RS": 22, "SA": 24, "SC": 31, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "TN": 24, "TR": 26, "UA": 29, "VA": 22, "VG": 24, "XK": 20,
}

#: Words that speak for a kind, and words that speak against any, in four languages; looked for in lower case.
CONTEXT = {
    "email": "e-?mail|mail|contact|kontakt|correo|courriel|contacto",
    "ip": "ip|address|adresse|server|host|direcci",
    "card": "card|visa|mastercard|credit|kredit|karte|tarjeta|carte",
    "phone": "tel|phone|call|fon|anruf|llam|appel|mobil|handy|m[oó]vil|fax",
    "iban": "iban|account|konto|cuenta|compte|bank",
    "tel": "tel|phone|call|fon|anruf|llam|appel|mobil|handy|m[oó]vil|fax",
    "pan": "card|visa|mastercard|credit|kredit|karte|tarjeta|carte",
}
AGAINST = "version|isbn|issn|order|invoice|rechnung|bestell|factura|pedido|facture|commande|token|hash|serial"
#: Score that a kind's pattern and validator give on their own.
VALIDATED = {"email": 0.8, "ip": 0.6, "card": 0.7, "phone": 0.7, "iban": 0.9, "tel": 0.3, "pan": 0.3}
FOR, LESS = 0.3, 0.3
#: Characters before and after a span that are looked at.
BEFORE, AFTER = 40, 20


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _running(values: Column, join: Callable[[Column, Column], Column]) -> Column:
    """Element i joined with all before it, by doubling steps; join must not mind a null on its right."""
    steps = F.sequence(F.lit(0), F.ceil(F.log2(F.greatest(F.size(values), F.lit(2)))).cast("int"))
    step = lambda acc, r: _let(F.pow(F.lit(2), r).cast("int"), lambda by: F.transform(acc, lambda x, i: join(x, F.get(acc, i - by))))
    return F.aggregate(steps, values, step)


def _hits(text: Column, pattern: str, maybe: Column) -> Column:
    """All matches in order: start, end (in code points), the match m, and the text before and after it up to its neighbours."""
    found = _let(
        F.struct(F.split(text, pattern, -1).alias("gaps"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("own")),
        lambda s: _let(
            _running(F.transform(s["own"], lambda m, i: (F.length(m) + F.length(F.get(s["gaps"], i))).cast("long")), lambda a, b: a + F.coalesce(b, F.lit(0))),
            lambda ends: F.transform(
                s["own"],
                lambda m, i: F.struct(
                    (F.get(ends, i) - F.length(m)).alias("start"), F.get(ends, i).alias("end"), m.alias("m"), F.right(F.get(s["gaps"], i), F.lit(BEFORE)).alias("before"), F.left(F.get(s["gaps"], i + 1), F.lit(AFTER)).alias("after")
                ),
            ),
        ),
    )
    return F.when(maybe, found).otherwise(F.from_json(F.lit("[]"), "array<struct<start:bigint,end:bigint,m:string,before:string,after:string>>"))


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    return F.call_function("luhn_check", digits)


def _mod97(account: Column) -> Column:
    """Remainder of an account number, letters as 10 to 35, with its first four characters moved to the end."""
    chars = F.split(F.concat(F.substr(account, F.lit(5)), F.substr(account, F.lit(1), F.lit(4))), "")
    value = lambda c: F.when(c.between("0", "9"), F.ascii(c) - 48).otherwise(F.ascii(c) - 55)
    return F.aggregate(F.filter(chars, lambda c: c != ""), F.lit(0), lambda r, c: (r * F.when(c.between("0", "9"), 10).otherwise(100) + value(c)) % 97)


def _iban(hit: Column, lengths: Column) -> Column:
    """The hit cut to its country's length, with `ok` if the number is whole and passes."""
    compact = F.replace(hit["m"], F.lit(" "), F.lit(""))
    n = F.coalesce(F.element_at(lengths, F.substr(hit["m"], F.lit(1), F.lit(2))), F.lit(99))
    spaces = F.when(F.contains(hit["m"], F.lit(" ")), F.floor((n - 1) / 4).cast("int")).otherwise(0)
    return _let(
        F.struct(n.alias("n"), (n + spaces).alias("long"), F.substr(compact, F.lit(1), n).alias("account")),
        lambda s: F.struct(
            hit["start"].alias("start"),
            (hit["start"] + s["long"]).alias("end"),
            hit["m"].alias("m"),
            hit["before"].alias("before"),
            F.concat(F.substr(hit["m"], s["long"] + 1, F.length(hit["m"])), hit["after"]).alias("after"),
            ((F.length(s["account"]) == s["n"]) & ~F.coalesce(F.rlike(hit["before"], F.lit(r"[A-Za-z0-9]\z")), F.lit(False)) & (_mod97(s["account"]) == 1)).alias("ok"),
        ),
    )


def _scored(hit: Column, kind: str) -> Column:
    near = F.lower(F.concat_ws(" ", hit["before"], hit["after"]))
    score = F.lit(VALIDATED[kind]) + F.when(F.rlike(near, F.lit(CONTEXT[kind])), FOR).otherwise(0.0) - F.when(F.rlike(near, F.lit(AGAINST)), LESS).otherwise(0.0)
    return F.struct(
        hit["start"].cast("long").alias("start"), F.lit(KINDS.index(kind)).alias("place"), hit["end"].cast("long").alias("end"), F.lit(kind).alias("kind"), F.round(F.greatest(F.least(score, F.lit(1.0)), F.lit(0.0)), 2).alias("score")
    )


def _free(candidates: Column, taken: Column) -> Column:
    """The candidates that overlap none of `taken`; both are in order of start, the ends of `taken` may be in any order."""
    marked = F.array_sort(
        F.concat(
            F.transform(taken, lambda s: F.struct(s["start"].alias("at"), F.lit(0).alias("own"), s["end"].alias("reach"), F.lit(None).cast(_SPAN).alias("span"))),
            F.transform(candidates, lambda s: F.struct(s["start"].alias("at"), F.lit(1).alias("own"), F.lit(None).cast("long").alias("reach"), s.alias("span"))),
        )
    )
    most = lambda a, b: F.greatest(a, b)  # noqa: E731  nulls are passed over
    least = lambda a, b: F.least(a, b)
    return _let(
        marked,
        lambda all_: _let(
            F.struct(
                _running(F.transform(all_, lambda x: F.coalesce(x["reach"], F.lit(-1).cast("long"))), most).alias("reach"),
                F.reverse(_running(F.reverse(F.transform(all_, lambda x: F.when(x["own"] == 0, x["at"]).otherwise(F.lit(1 << 60)).cast("long"))), least)).alias("next"),
            ),
            lambda lim: F.transform(F.filter(F.transform(all_, lambda x, i: F.struct(x["span"].alias("span"), ((x["own"] == 1) & (F.get(lim["reach"], i) <= x["at"]) & (F.get(lim["next"], i) >= x["span"]["end"])).alias("ok"))), lambda x: x["ok"]), lambda x: x["span"]),
        ),
    )


_SPAN = "struct<start:bigint,place:int,end:bigint,kind:string,score:double>"


def spans_of(text: Column, threshold: float = 0.6) -> Column:
    """All spans of a text, sorted: array of (start, place of the kind, end, kind, score)."""
    text = F.coalesce(text, F.lit(""))
    digit = F.rlike(text, F.lit("[0-9]"))
    keep = lambda hits, ok, kind: F.transform(F.filter(hits, ok), lambda h: _scored(h, kind))
    n = lambda h: F.length(_digits(h["m"]))
    octet = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
    email = keep(_hits(text, _EMAIL, F.contains(text, F.lit("@"))), lambda h: F.lit(True), "email")
    ip = keep(_hits(text, _IP, F.rlike(text, F.lit(r"[0-9]\.[0-9]"))), lambda h: F.rlike(h["m"], F.lit(rf"^{octet}(?:\.{octet}){{3}}\z")), "ip")
    card = keep(_hits(text, _CARD, digit), lambda h: n(h).between(14, 19) & F.when(n(h) <= 19, _luhn(_digits(h["m"]))).otherwise(False), "card")
    phone = keep(_hits(text, _PHONE, F.rlike(text, F.lit(r"\+[0-9]"))), lambda h: n(h).between(10, 15), "phone")
    lengths = F.create_map(*[F.lit(x) for pair in IBAN_LENGTHS.items() for x in pair])
    iban = keep(F.transform(_hits(text, _IBAN, F.rlike(text, F.lit("[A-Z]{2}[0-9]{2}"))), lambda h: _iban(h, lengths)), lambda h: h["ok"], "iban")
    alone = lambda h: ~F.coalesce(F.rlike(h["before"], F.lit(r"[A-Za-z0-9+.,=\"'-]\z")), F.lit(False)) & ~F.coalesce(F.rlike(h["after"], F.lit(r"^[A-Za-z0-9@=]")), F.lit(False))
    number = _hits(text, _NUMBER, F.rlike(F.lower(text), F.lit(f"{CONTEXT['tel']}|{CONTEXT['pan']}")) & F.rlike(text, F.lit("[0-9](?:[\\x20()./-]{0,2}[0-9]){6}")))
    weak = _let(
        F.filter(number, alone),
        lambda hits: F.array_sort(
            F.concat(
                keep(hits, lambda h: n(h).between(12, 19) & F.when(n(h) <= 19, _luhn(_digits(h["m"]))).otherwise(False), "pan"),
                keep(hits, lambda h: n(h).between(7, 15) & ~((n(h) >= 12) & F.when(n(h) <= 19, _luhn(_digits(h["m"]))).otherwise(False)), "tel"),
            )
        ),
    )
    return _let(F.concat(email, ip, card, phone, F.filter(iban, lambda s: s["score"] >= threshold)), lambda strong: F.array_sort(F.concat(strong, _free(F.filter(weak, lambda s: s["score"] >= threshold), F.array_sort(strong)))))


def find(docs: DataFrame, column: str = "text", threshold: float = 0.6) -> DataFrame:
    """docs with `spans`: an array of (kind, start, end, score), places in code points, ends exclusive, by start and kind."""
    spans = F.transform(spans_of(F.col(column), threshold), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["score"].alias("score")))
    return docs.withColumn("spans", spans)


def joined(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The number of base spans of each kind, the hash of the base spans, and all spans as text."""
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    return found.select(F.col(id_col).cast("long").alias(id_col), *map(count, BASE), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def redact(docs: DataFrame, column: str = "text", threshold: float = 0.6) -> DataFrame:
    """docs with each span of the text replaced by its kind in angle brackets; of overlapping spans the first in order stands."""
    text = F.coalesce(F.col(column), F.lit(""))
    cut = lambda spans: _let(
        _running(F.transform(spans, lambda s: s["end"]), F.greatest),
        lambda reach: F.concat(
            F.array_join(F.transform(spans, lambda s, i: _let(F.coalesce(F.get(reach, i - 1), F.lit(0).cast("long")), lambda at: F.when(s["start"] >= at, F.concat(F.substr(text, (at + 1).cast("int"), (s["start"] - at).cast("int")), F.lit("<"), s["kind"], F.lit(">"))).otherwise(""))), ""),
            F.substr(text, (F.coalesce(F.get(reach, F.size(spans) - 1), F.lit(0).cast("long")) + 1).cast("int")),
        ),
    )
    return docs.withColumn(column, F.when(F.col(column).isNotNull(), _let(spans_of(F.col(column), threshold), lambda s: F.when(F.size(s) > 0, cut(s)).otherwise(text))))
