"""Format-preserving pseudonyms for personal data (operator 1), in SQL expressions alone.

A value is validated (checksum, ranges, calendar), mapped to a pair of numbers, permuted by a keyed
Feistel network over that pair and written back in its own format: a card number stays a valid card
number, a date a valid date. The permutation depends only on key, kind and value, so equal values get
equal pseudonyms in every document, and different values different ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROUNDS = 8

# Formats of the kinds, as regular expressions; the first that fits at a place is taken.
EMAIL = r"(?<![\w.+%-])[A-Za-z0-9._%+-]{1,64}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}(?![A-Za-z0-9-])"
TELLING = r"(?i:password|passwd|secret|token|api_key)"
SECRET = (
    r"(?<![A-Za-z0-9])AKIA[A-Z0-9]{16}(?![A-Za-z0-9])"
    rf"|(?<=[=:\"' ])(?<={TELLING}[\"']? {{0,3}}[=:] {{0,3}}[\"']?)[A-Za-z0-9]{{8,64}}(?![A-Za-z0-9])"
)
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
ADDRESS = rf"(?<![\d.])(?:{OCTET}\.){{3}}{OCTET}(?!\.?\d)"
DATE = (
    r"(?<![\d./-])(?:\d{4}-\d{2}-\d{2}|\d{4}/\d{2}/\d{2}|\d{4}\.\d{2}\.\d{2}"
    r"|\d{2}-\d{2}-\d{4}|\d{2}/\d{2}/\d{4}|\d{2}\.\d{2}\.\d{4})(?![\d/-]|\.\d)"
)
SOCIAL = r"(?<![\d-])(?!000|666|9)\d{3}-(?!00)\d{2}-(?!0000)\d{4}(?![\d-])"
CALL = r"[2-9]\d{2}"
PHONE = (
    r"(?<![\d+])\+1[ .-]?(?:\(\d{3}\)|\d{3})[ .-]?\d{3}[ .-]?\d{4}(?!\d)"
    rf"|(?<![\d+])\(\d{{3}}\) ?\d{{3}}[ .-]\d{{4}}(?!\d)|(?<![\d+.-]){CALL}[.-]{CALL}[.-]\d{{4}}(?![\d.-])"
)
ABROAD = r"(?<![\d+])\+[2-9]\d{0,2}(?:[ .-]?(?:\(\d{1,4}\)|\d{1,4})){2,5}(?!\d)"
CARD = (
    r"(?<![\d.-])(?:\d{4}(?: \d{4}){3}(?: \d{1,3})?|\d{4}(?:-\d{4}){3}(?:-\d{1,3})?|\d{4} \d{6} \d{5}"
    r"|\d{4}-\d{6}-\d{5}|\d{13,19})(?!\d)"
)
ANY = "|".join((EMAIL, SECRET, IBAN, ADDRESS, DATE, SOCIAL, PHONE, ABROAD, CARD))

# days of the Gregorian cycle of 400 years, 189 * 773; dates are permuted within 1800 to 2199
FIRST_DAY, CYCLE = "DATE'1800-01-01'", 146_097


def quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def let(value: str, name: str, body: str) -> str:
    """``body`` with ``name`` for a value that is computed once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def digits(value: str) -> str:
    return f"regexp_replace({value}, '[^0-9]', '')"


class Pseudonyms:
    """Builder of the expressions under one key."""

    def __init__(self, key: str):
        self.key = quoted(key)

    def feistel(self, kind: str, left: str, right: str, lefts: str, rights: str) -> str:
        """The pair permuted within ``lefts`` x ``rights``: each round adds a keyed hash of one half to
        the other, so the map is one to one for any two sizes."""

        def mixed(half: str) -> str:
            hashed = f"sha2(concat_ws('|', {self.key}, '{kind}', {lefts}, {rights}, i, {half}), 256)"
            return f"CAST(conv(substr({hashed}, 1, 15), 16, 10) AS BIGINT)"

        start = f"named_struct('l', CAST({left} AS BIGINT), 'r', CAST({right} AS BIGINT))"
        return (
            f"aggregate(sequence(1, {ROUNDS}), {start}, (s, i) -> named_struct("
            f"'l', IF(i % 2 = 1, pmod(s.l + {mixed('s.r')}, {lefts}), s.l), "
            f"'r', IF(i % 2 = 0, pmod(s.r + {mixed('s.l')}, {rights}), s.r)))"
        )

    def number(self, kind: str, value: str) -> str:
        """A string of 2 to 30 digits permuted among those of its length."""
        half = f"(length({value}) DIV 2)"
        power = "CAST(pow(10, {}) AS BIGINT)".format
        rest = f"(length({value}) - {half})"
        moved = self.feistel(kind, f"substr({value}, 1, {half})", f"substr({value}, {half} + 1)", power(half), power(rest))
        return let(moved, "p", f"concat(lpad(p.l, {half}, '0'), lpad(p.r, {rest}, '0'))")

    def refill(self, value: str, new: str) -> str:
        """``value`` with its digits replaced by those of ``new``, one by one."""
        step = (
            f"IF(substr({value}, i, 1) BETWEEN '0' AND '9', "
            f"named_struct('o', concat(s.o, substr(nd, s.k, 1)), 'k', s.k + 1), "
            f"named_struct('o', concat(s.o, substr({value}, i, 1)), 'k', s.k))"
        )
        walk = f"aggregate(sequence(1, length({value})), named_struct('o', '', 'k', 1), (s, i) -> {step}, s -> s.o)"
        return let(new, "nd", walk)

    def luhn(self, value: str, skipped: int) -> str:
        """Luhn sum of a digit string that lacks its last ``skipped`` digits."""
        digit = f"CAST(substr({value}, length({value}) + 1 - i, 1) AS INT)"
        doubled = f"IF({digit} > 4, 2 * {digit} - 9, 2 * {digit})"
        odd = f"(i + {skipped}) % 2 = 0"
        return f"aggregate(sequence(1, length({value})), 0, (t, i) -> t + IF({odd}, {doubled}, {digit}))"

    def card(self, v: str) -> str:
        inner = self.number("card", "substr(d, 2, length(d) - 2)")
        checked = let(f"concat(substr(d, 1, 1), {inner})", "b", f"concat(b, pmod(10 - {self.luhn('b', 1)} % 10, 10))")
        fits = f"length(d) BETWEEN 13 AND 19 AND substr(d, 1, 1) <> '0' AND {self.luhn('d', 0)} % 10 = 0"
        return let(digits(v), "d", f"IF({fits}, {self.refill(v, checked)}, NULL)")

    def address(self, v: str) -> str:
        part = "CAST(element_at(o, {}) AS BIGINT)".format
        moved = self.feistel("address", f"{part(1)} * 256 + {part(2)}", f"{part(3)} * 256 + {part(4)}", "65536L", "65536L")
        written = "concat_ws('.', p.l DIV 256, p.l % 256, p.r DIV 256, p.r % 256)"
        return let(f"split({v}, '[.]')", "o", let(moved, "p", written))

    def social(self, v: str) -> str:
        area = f"CAST(substr({v}, 1, 3) AS BIGINT)"
        left = f"(IF({area} > 666, {area} - 2, {area} - 1) * 99 + CAST(substr({v}, 5, 2) AS BIGINT) - 1)"
        moved = self.feistel("social", left, f"CAST(substr({v}, 8, 4) AS BIGINT) - 1", "88902L", "9999L")
        back = "IF(p.l DIV 99 + 1 > 665, p.l DIV 99 + 2, p.l DIV 99 + 1)"
        return let(moved, "p", f"concat(lpad({back}, 3, '0'), '-', lpad(p.l % 99 + 1, 2, '0'), '-', lpad(p.r + 1, 4, '0'))")

    def phone(self, v: str) -> str:
        """Area and exchange from 200 to 999 stay so, those below 200 too; a leading 1 stays."""
        place = "CAST(substr(d, {}, 3) AS BIGINT)".format
        low, count = "IF({0} < 200, 0, 200)".format, "IF({0} < 200, 200L, 800L)".format
        area, exchange = place(1), place(4)
        left = f"({area} - {low(area)}) * {count(exchange)} + {exchange} - {low(exchange)}"
        moved = self.feistel("phone", left, "substr(d, 7, 4)", f"({count(area)} * {count(exchange)})", "10000L")
        back = (
            f"lpad(p.l DIV {count(exchange)} + {low(area)}, 3, '0'), lpad(p.l % {count(exchange)} + {low(exchange)}, 3, '0')"
        )
        new = let(moved, "p", f"concat({back}, lpad(p.r, 4, '0'))")
        code = f"IF(length({digits(v)}) = 11, '1', '')"
        return let(f"right({digits(v)}, 10)", "d", self.refill(v, f"concat({code}, {new})"))

    def abroad(self, v: str) -> str:
        """The first two digits (of the country) stay."""
        new = f"concat(substr(d, 1, 2), {self.number('abroad', 'substr(d, 3)')})"
        return let(digits(v), "d", f"IF(length(d) BETWEEN 8 AND 15, {self.refill(v, new)}, NULL)")

    def iban(self, v: str) -> str:
        """Country and letters stay, the account's digits are permuted, the check digits made anew."""
        rest = "aggregate(sequence(1, length({0})), 0, (t, i) -> IF(substr({0}, i, 1) BETWEEN '0' AND '9', (t * 10 + CAST(substr({0}, i, 1) AS INT)) % 97, (t * 100 + ascii(substr({0}, i, 1)) - 55) % 97))".format
        fits = f"length(c) BETWEEN 15 AND 34 AND length({digits('substr(c, 5)')}) >= 2 AND {rest('w')} = 1"
        account = let(
            digits("substr(c, 5)"),
            "a",
            let(self.number("iban", "a"), "b", self.refill("substr(c, 5)", "b")),
        )
        check = let(f"concat(n, substr(c, 1, 2), '00')", "q", f"lpad(98 - {rest('q')}, 2, '0')")
        new = let(account, "n", f"concat({check}, {digits('n')})")
        whole = let("concat(substr(c, 5), substr(c, 1, 4))", "w", f"IF({fits}, {self.refill(v, new)}, NULL)")
        return let(f"replace({v}, ' ', '')", "c", whole)

    def day(self, day: str) -> str:
        left, right = f"datediff({day}, {FIRST_DAY}) DIV 773", f"datediff({day}, {FIRST_DAY}) % 773"
        moved = self.feistel("date", left, right, "189L", "773L")
        return let(moved, "p", f"date_add({FIRST_DAY}, CAST(p.l * 773 + p.r AS INT))")

    def date(self, v: str) -> str:
        """Year first; day first with dots or hyphens; month first with slashes, unless only day first is
        a date: then among dates of which that holds (walking along the permutation until it does)."""
        year = f"IF({v} RLIKE '^[0-9]{{4}}', substr({v}, 1, 4), right({v}, 4))"
        sep = f"substr({v}, IF({v} RLIKE '^[0-9]{{4}}', 5, 3), 1)"
        parsed = (
            f"CASE WHEN {v} RLIKE '^[0-9]{{4}}' THEN named_struct('f', concat('yyyy', {sep}, 'MM', {sep}, 'dd'), 'w', false) "
            f"WHEN {sep} <> '/' THEN named_struct('f', concat('dd', {sep}, 'MM', {sep}, 'yyyy'), 'w', false) "
            f"WHEN substr({v}, 1, 2) > '12' THEN named_struct('f', 'dd/MM/yyyy', 'w', true) "
            f"ELSE named_struct('f', 'MM/dd/yyyy', 'w', false) END"
        )
        walk = (
            f"IF(f.w, aggregate(sequence(1, 64), named_struct('d', t, 'k', 0), (z, j) -> IF(z.k > 0 AND day(z.d) > 12, z, "
            f"named_struct('d', {self.day('z.d')}, 'k', z.k + 1)), z -> z.d), {self.day('t')})"
        )
        fits = f"t IS NOT NULL AND CAST({year} AS INT) BETWEEN 1800 AND 2199"
        return let(parsed, "f", let(f"CAST(try_to_timestamp({v}, f.f) AS DATE)", "t", f"IF({fits}, date_format({walk}, f.f), NULL)"))

    def letters(self, kind: str, value: str) -> str:
        """Digits, small and capital letters permuted within their own sets, other signs as they are."""
        shift = f"CAST(conv(substr(h, 1 + 2 * (j % 32), 2), 16, 10) AS INT)"
        small = f"IF(x.t, 6, 26)"
        sign = "substr({}, j + 1, 1)".format

        def moved(half: str, by: str) -> str:
            one = (
                f"CASE WHEN {sign(half)} BETWEEN '0' AND '9' THEN chr(48 + (ascii({sign(half)}) - 48 + {shift}) % 10) "
                f"WHEN {sign(half)} BETWEEN 'a' AND 'z' THEN chr(97 + (ascii({sign(half)}) - 97 + {shift}) % {small}) "
                f"WHEN {sign(half)} BETWEEN 'A' AND 'Z' THEN chr(65 + (ascii({sign(half)}) - 65 + {shift}) % 26) "
                f"ELSE {sign(half)} END"
            )
            hashed = f"sha2(concat_ws('|', {self.key}, '{kind}', i, length({half}), {by}), 256)"
            every = f"array_join(transform(sequence(0, length({half}) - 1), j -> {one}), '')"
            return f"IF({half} = '', '', {let(hashed, 'h', every)})"

        rounds = (
            f"aggregate(sequence(1, {ROUNDS}), named_struct('l', substr(x.v, 1, length(x.v) DIV 2), "
            f"'r', substr(x.v, length(x.v) DIV 2 + 1)), (s, i) -> named_struct("
            f"'l', IF(i % 2 = 0, {moved('s.l', 's.r')}, s.l), 'r', IF(i % 2 = 1, {moved('s.r', 's.l')}, s.r)), "
            f"s -> concat(s.l, s.r))"
        )
        return let(f"named_struct('v', {value}, 't', {value} RLIKE '^[0-9a-f]+$')", "x", rounds)

    def email(self, v: str) -> str:
        return f"concat({self.letters('email', f'substring_index({v}, chr(64), 1)')}, '@', substring_index({v}, '@', -1))"

    def secret(self, v: str) -> str:
        whole = self.letters("secret", v)
        return f"IF({v} RLIKE '^AKIA', concat('AKIA', {self.letters('secret', f'substr({v}, 5)')}), {whole})"

    def replaced(self, v: str) -> str:
        """The pseudonym of a value that one of the formats found; null if it is not a valid one."""
        kinds = [
            (r"@", self.email(v)),
            (rf"^(?:{OCTET}\.){{3}}{OCTET}$", self.address(v)),
            (r"^(?:\d{4}([-/.])\d{2}\1\d{2}|\d{2}([-/.])\d{2}\2\d{4})$", self.date(v)),
            (r"^\d{3}-\d{2}-\d{4}$", self.social(v)),
            (r"^(?:\+1[ .-]?(?:\(\d{3}\)|\d{3})|\(\d{3}\)|\d{3}[.-])[ .-]?\d{3}[ .-]?\d{4}$", self.phone(v)),
            (r"^\+", self.abroad(v)),
            (r"^\d[\d -]{12,}$", f"coalesce({self.card(v)}, {v})"),
            (r"^[A-Z]{2}\d{2} ?[A-Z0-9]{4}", f"coalesce({self.iban(v)}, IF({v} RLIKE '^[A-Za-z0-9]+$', {self.secret(v)}, NULL))"),
        ]
        cases = " ".join(f"WHEN {v} RLIKE {quoted(pattern)} THEN {made}" for pattern, made in kinds)
        return f"CASE {cases} WHEN {v} RLIKE '^[A-Za-z0-9]+$' THEN {self.secret(v)} END"


def found(text: Column) -> Column:
    """Every value in the text that has one of the formats, in order."""
    return F.when(text.rlike(f"[0-9@]|{TELLING}"), F.regexp_extract_all(text, F.lit(ANY), F.lit(0))).otherwise(
        F.array().cast("array<string>")
    )


def pseudonymise(df: DataFrame, key: str, text: str = "text", count: str | None = None) -> DataFrame:
    """``df`` with ``text`` rewritten, and the number of replaced values in column ``count`` if it is named.

    Emails (the part before the sign), IPv4 addresses, dates from 1800 to 2199, social security, phone,
    card and account numbers, and secrets after a telling name. What only looks like one of them (a wrong
    checksum, an impossible date) stays. Null texts stay null with count 0, empty ones empty; rows are
    rewritten one by one, so repeated rows stay alike; all other columns stay as they are.
    """
    column = df[text]
    values = found(F.coalesce(column, F.lit("")))
    # a lambda over the values: each is replaced by itself where it is not valid
    new = F.expr(f"transform(_found, v -> coalesce({Pseudonyms(key).replaced('v')}, v))")
    names = [c for c in df.columns if c not in (text, count)]
    work = df.select(
        F.struct(*[df[c] for c in names]).alias("_rest") if names else F.lit(None).alias("_rest"),
        column.alias("_text"),
        values.alias("_found"),
    ).withColumn("_new", F.when(F.size("_found") > 0, new).otherwise(F.col("_found")))
    pieces = F.split(F.col("_text"), ANY, -1)
    joined = F.array_join(
        F.flatten(F.zip_with(pieces, F.col("_new"), lambda p, n: F.array(p, F.coalesce(n, F.lit(""))))), ""
    )
    changed = F.size(F.filter(F.arrays_zip("_found", "_new"), lambda z: z["_found"] != z["_new"])).cast("bigint")
    made = {text: F.when(F.size("_found") > 0, joined).otherwise(F.col("_text")), count: changed}
    order = [*df.columns, *([count] if count and count not in df.columns else [])]
    return work.select(*[(made[c] if c in made else F.col("_rest")[c]).alias(c) for c in order])


def op1_pseudonyms(spark: SparkSession, sf_dir: str, key: str = "a key of one's own") -> DataFrame:
    """Every document with pseudonyms for its personal data."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return pseudonymise(docs.select("doc_id", "text"), key, count="n_replaced")
