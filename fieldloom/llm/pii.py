"""Personal data: fixed patterns, and boosted trees over the candidates of wider generators."""

from __future__ import annotations

import functools
import random

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldloom.llm import boosting
from fieldloom.llm.quality import let

KINDS = ("email", "ip", "card", "phone", "secret")
#: The base patterns, written so that no run of characters is scanned twice.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
#: Wider patterns that propose candidates of a kind; proposals of two generators may overlap.
GENERATORS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?(?:@|[(\[{] ?(?:at|@) ?[)\]}]| at ) ?[A-Za-z0-9-]++(?: ?(?:\.|[(\[{] ?(?:dot|\.) ?[)\]}]| dot ) ?[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9.])[0-9]{1,3}(?: ?(?:\.|[(\[]\.[)\]]) ?[0-9]{1,3}){3}(?![0-9.])",
    "number": r"(?<![0-9A-Za-z])[+(]?[0-9](?:[ ().\-/]{0,2}[0-9])++",
    "secret": r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]{0,40}[0-9])[A-Za-z0-9+/_-]{16,}+={0,2}",
}
_HINTS = {
    "phone": r"(?i)\b(?:tel|phone|call|mobile|cell|fax|whatsapp|telefon|téléphone|teléfono|reach)\b",
    "card": r"(?i)\b(?:card|visa|mastercard|amex|credit|debit|karte|carte|tarjeta)\b",
    "ip": r"(?i)\b(?:ip|host|server|address|addr|from|ping|ssh|client)\b",
    "email": r"(?i)\b(?:e-?mail|mail|contact|write|reach|correo|schreib)\b",
    "secret": r"(?i)(?:token|secret|passw|pwd|api.?key|access.?key|bearer|auth|credential)[a-z_]*[\"']? {0,2}[:=]? {0,2}[\"']?$",
    "hash": r"(?i)\b(?:commit|sha-?[0-9]*|md5|checksum|digest|etag|uuid|guid|build|urn|https?)\b",
    "other": r"(?i)\b(?:order|invoice|id|isbn|version|release|date|price|serial|ref|reference|tracking|chapter|section|look|arrive|meet)\b",
}
FEATURES = ("kind", "n_digits", "n_chars", "n_groups", "longest", "n_space", "n_dot", "n_dash", "n_paren", "plus", "luhn", "veiled", "first", "hex", "n_kinds", "n_letters", *(f"near_{k}" for k in _HINTS), "tied_before", "tied_after")


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a digit string passes the Luhn sum."""
    ds = F.reverse(F.split(digits, ""))
    value = F.transform(ds, lambda d, i: let(d.cast("int") * (1 + i % 2), lambda v: F.when(v > 9, v - 9).otherwise(v)))
    return F.aggregate(value, F.lit(0), lambda a, v: a + v) % 10 == 0


def running(rows: Column, start: Column, add) -> Column:
    """The state before each element of an array, where `add(state, element)` is the state after it.

    An array grows by copying, so it is built in blocks of the square root of its size: an array of a million
    elements takes a thousand times as long as one of ten thousand, not ten thousand times.
    """

    def states(block: Column, first: Column) -> Column:
        none = F.filter(F.array(first), lambda _: F.lit(False))
        return F.aggregate(block, F.struct(first.alias("at"), none.alias("out")), lambda acc, x: F.struct(add(acc["at"], x).alias("at"), F.array_append(acc["out"], acc["at"]).alias("out")), lambda acc: acc["out"])

    def in_blocks(blocks: Column) -> Column:
        none = F.filter(F.array(start), lambda _: F.lit(False))
        firsts = F.aggregate(blocks, F.struct(start.alias("at"), none.alias("out")), lambda acc, b: F.struct(F.aggregate(b, acc["at"], add).alias("at"), F.array_append(acc["out"], acc["at"]).alias("out")), lambda acc: acc["out"])
        return F.flatten(F.zip_with(blocks, firsts, states))

    def cut(all_: Column) -> Column:
        width = F.ceil(F.sqrt(F.size(all_))).cast("int")
        return let(F.transform(F.sequence(F.lit(0), F.floor((F.size(all_) - 1) / width).cast("int")), lambda k: F.slice(all_, k * width + 1, width)), in_blocks)

    return let(rows, lambda all_: F.when(F.size(all_) > 64, cut(all_)).otherwise(states(all_, start)))


def found(text: Column, pattern: str) -> Column:
    """All matches of a pattern, leftmost and non-overlapping: array of (start, end, s, before, after), in code points.

    `before` is up to 24 characters before a match, as far as the match before it reaches, and `after` the one behind.
    """
    steps = F.zip_with(F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda gap, s: F.struct(gap.alias("gap"), s.alias("s")))

    def placed(rows: Column) -> Column:
        at = running(rows, F.lit(0), lambda at, x: at + F.length(x["gap"]) + F.coalesce(F.length(x["s"]), F.lit(0)))

        def one(x: Column, at: Column, i: Column) -> Column:
            start = at + F.length(x["gap"])
            before = F.concat(F.coalesce(F.get(rows, i - 1)["s"], F.lit("")), x["gap"])
            return F.struct(start.alias("start"), (start + F.length(x["s"])).alias("end"), x["s"].alias("s"), F.right(before, F.lit(24)).alias("before"), F.left(F.get(rows, i + 1)["gap"], F.lit(1)).alias("after"))

        joined = F.zip_with(rows, at, lambda x, y: F.struct(x.alias("x"), y.alias("at")))
        return F.filter(F.transform(joined, lambda z, i: one(z["x"], z["at"], i)), lambda x: x["s"].isNotNull())

    return let(steps, placed)


def _valid(kind: str, s: Column) -> Column:
    if kind == "ip":
        return s.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$")
    if kind == "card":
        return let(_digits(s), lambda d: F.length(d).between(13, 19) & luhn(d))
    if kind == "phone":
        return F.length(_digits(s)).between(9, 15)
    return F.lit(True)


def _named(kind: str, spans: Column) -> Column:
    return F.transform(spans, lambda x: F.struct(F.lit(KINDS.index(kind)).alias("kind"), x["start"].alias("start"), x["end"].alias("end")))


def base_spans(text: Column) -> Column:
    """The base spans of a text, by kind as listed, then start. A kind is searched only where its mark occurs."""
    marks = {"email": text.contains("@"), "ip": text.rlike(r"[0-9]\.[0-9]"), "card": text.rlike(r"[0-9][\x20-]?[0-9]"), "phone": text.contains("+")}
    none = F.expr("cast(array() as array<struct<kind:int,start:int,end:int>>)")

    def one(kind: str) -> Column:
        return F.when(marks[kind], _named(kind, F.filter(found(text, BASE[kind]), lambda x: _valid(kind, x["s"])))).otherwise(none)

    return F.concat(*map(one, BASE))


def candidates(text: Column) -> Column:
    """Overlapping proposals of the generators, each with its features (FEATURES) as doubles."""

    def described(kind: str, spans: Column) -> Column:
        def one(x: Column) -> Column:
            s, before = x["s"], x["before"]
            digits = _digits(s)
            groups = F.array_remove(F.split(s, "[^0-9]+"), "")
            number = lambda c: c.cast("double")
            values = [
                F.lit(float(KINDS.index(kind))), number(F.length(digits)), number(F.length(s)), number(F.size(groups)),
                number(F.coalesce(F.array_max(F.transform(groups, F.length)), F.lit(0))), number(F.regexp_count(s, F.lit(" "))), number(F.regexp_count(s, F.lit(r"\."))),
                number(F.regexp_count(s, F.lit("[-/]"))), number(F.regexp_count(s, F.lit("[()]"))), number(s.startswith("+")),
                number(F.coalesce(F.length(digits).between(13, 19) & luhn(digits), F.lit(False))), number(s.rlike(r"[(\[{] ?(?:at|dot|@|\.) ?[)\]}]")), number(F.coalesce(F.substring(digits, 1, 1).try_cast("int"), F.lit(-1))),
                number(s.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$")), number(F.size(F.array_distinct(F.split(s, "")))), number(F.regexp_count(s, F.lit("[A-Za-z]"))),
                *[number(before.rlike(p)) for p in _HINTS.values()], number(before.rlike(r"[A-Za-z0-9._/-]$")), number(x["after"].rlike(r"[A-Za-z0-9_/]")),
            ]
            return F.struct(F.lit(KINDS.index(kind)).alias("kind"), x["start"].alias("start"), x["end"].alias("end"), F.array(*values).alias("f"))

        return F.transform(spans, one)

    none = F.expr("cast(array() as array<struct<kind:int,start:int,end:int,f:array<double>>>)")
    digits = text.rlike("[0-9]")
    mail = text.contains("@") | text.rlike(r"[(\[{] ?at ?[)\]}]") | text.rlike(r" at [A-Za-z0-9-]+ dot ")
    long = text.rlike(r"[A-Za-z+/_-]{0,40}[0-9][A-Za-z0-9+/_-]{6}") & text.rlike(r"[A-Za-z0-9+/_-]{16}")

    def sized(all_: Column, kind: str, low: int, high: int) -> Column:
        return described(kind, F.filter(all_, lambda x: F.length(_digits(x["s"])).between(low, high)))

    numbers = let(found(text, GENERATORS["number"]), lambda all_: F.concat(sized(all_, "card", 13, 19), sized(all_, "phone", 8, 15)))
    return F.concat(
        F.when(mail, described("email", found(text, GENERATORS["email"]))).otherwise(none),
        F.when(digits, F.concat(described("ip", found(text, GENERATORS["ip"])), numbers)).otherwise(none),
        F.when(long, described("secret", found(text, GENERATORS["secret"]))).otherwise(none),
    )


def examples(rows: int, seed: int = 1) -> list[tuple[str, str, int]]:
    """Made-up (kind, text, label) rows: personal data in many formats among words, and look-alikes that are none."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice(("er", "th", "on", "an", "re", "le", "ou", "sch", "ei", "ci", "ar", "mi", "ta")) for _ in range(r.randint(1, 4)))
    words = lambda n: " ".join(word() for _ in range(n))
    d = lambda n: "".join(r.choice("0123456789") for _ in range(n))

    hexa = lambda n: "".join(r.choice("0123456789abcdef") for _ in range(n))
    mixed = lambda n: "".join(r.choice("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789") for _ in range(n))

    def card(ok: bool) -> str:
        n = r.choice((13, 15, 16, 16, 16, 19))
        body = r.choice("3456") + d(n - 2)
        total = sum(v - 9 if (v := int(c) * (2 - i % 2)) > 9 else v for i, c in enumerate(reversed(body)))
        last = (10 - total % 10) % 10
        return body + str(last if ok else (last + r.randint(1, 9)) % 10)

    def grouped(s: str, sep: str) -> str:
        return sep.join(s[i : i + 4] for i in range(0, len(s), 4))

    yes = {
        "email": lambda: f"{word()}.{word()}{r.choice((' (at) ', '(at)', ' [at] ', '[at]', '{at}'))}{word()}{r.choice((' (dot) ', '[dot]', '.', ' dot '))}{r.choice(('com', 'org', 'net', 'example'))}",
        "ip": lambda: r.choice(("[.]", "(.)", " . ")).join(str(r.randint(1, 254)) for _ in range(4)),
        "card": lambda: grouped(card(True), r.choice((".", "/", "  ", " - "[:2]))),
        "phone": lambda: r.choice((f"({d(3)}) {d(3)}-{d(4)}", f"{d(3)}-{d(3)}-{d(4)}", f"0{d(3)} {d(7)}", f"{d(3)}.{d(3)}.{d(4)}", f"0{d(2)}/{d(7)}")),
        "secret": lambda: r.choice(("", '= "', ": ", "= ", "='", ":")) + r.choice((hexa(32), hexa(40), hexa(64), mixed(20), mixed(32), mixed(40), "AK" + mixed(18).upper(), "ghp_" + mixed(36), "sk-" + mixed(32))) + r.choice(("", '"')),
    }
    no = {
        "email": lambda: r.choice((f"{word()} at {word()}.com", f"{word()} at {word()} dot {word()}", f"@{word()}.{word()}")),
        "ip": lambda: r.choice((".".join(str(r.randint(256, 999)) for _ in range(4)), f"{r.randint(1, 9)} . {d(2)} . {d(2)} . {d(3)}", f"v{d(1)}.{d(1)}.{d(2)}.{d(3)}")),
        "card": lambda: r.choice((card(False), d(16) if r.random() < 0.5 else card(False), grouped(card(False), r.choice((" ", "-", "."))), d(18))),
        "phone": lambda: r.choice((f"20{d(2)}-{d(2)}-{d(2)} {d(2)}:{d(2)}", d(8), d(10), d(13), f"{d(4)}-{d(4)}", f"20{d(2)}/{d(2)}/{d(2)}", f"978-{d(1)}-{d(2)}-{d(6)}-{d(1)}", f"{d(1)}.{d(3)}.{d(3)}.{d(3)}")),
        "secret": lambda: r.choice((hexa(40), hexa(32), hexa(7) + mixed(12), f"{hexa(8)}-{hexa(4)}-{hexa(4)}-{hexa(4)}-{hexa(12)}", "-".join(word() for _ in range(5)) + f"-{d(2)}", f"{word()}/{word()}/{word()}/{word()}-{d(3)}", f"{word()}_{word()}_{word()}{word()}{d(1)}", d(20))),
    }
    hint = {"email": ("mail", "contact", "write"), "ip": ("host", "server", "ip"), "card": ("card", "visa", "credit"), "phone": ("call", "tel", "phone", "mobile", "fax"), "secret": ("token", "TOKEN", "secret", "api_key", "apikey", "password", "access_key", "Bearer", "auth_token")}
    other = ("commit", "sha", "checksum", "md5", "build", "uuid", "order", "invoice", "id", "isbn", "version", "date", "price", "serial", "ref", "look", "chapter")
    out = []
    for i in range(rows):
        kind, label = KINDS[i % len(KINDS)], int(r.random() < 0.4)
        lead = r.choice(hint[kind]) if r.random() < (0.75 if label else 0.05) else r.choice(other) if not label and r.random() < 0.5 else word()
        if kind in ("phone", "secret") and label:
            lead = r.choice(hint[kind])  # digits alone are no telephone number, nor is a random string a secret
        if kind == "secret" and not label:
            lead = r.choice((*other, *other, word()))
        out.append((kind, f"{words(4)} {lead} {(yes if label else no)[kind]()} {words(3)}", label))
    return out


@functools.lru_cache(maxsize=1)
def _model(session: SparkSession, rows: int, precision: float) -> tuple[float, list, tuple[float, ...]]:
    """Trees fitted on two thirds of `rows` made-up texts, and per kind the lowest threshold that holds `precision` on the rest."""
    made = examples(rows)
    texts = F.lit([t for _, t, _ in made])
    table = session.range(1).select(F.posexplode(texts).alias("at", "text"))
    x, y, kinds, held = [], [], [], []
    for row in table.select("at", candidates(F.col("text")).alias("c")).collect():  # `rows` texts
        kind, _, label = made[row["at"]]
        for c in row["c"]:
            if c["kind"] == KINDS.index(kind):
                x.append(c["f"])
                y.append(label)
                kinds.append(c["kind"])
                held.append(row["at"] // 4 % 3 == 0)
    x, y, kinds, held = np.array(x), np.array(y, float), np.array(kinds), np.array(held)
    start, trees = boosting.fit(x[~held], y[~held])
    p = 1 / (1 + np.exp(-(start + boosting.predict(trees, x))))
    cuts = []
    for k in range(len(KINDS)):
        rest = held & (kinds == k)
        fit = [t for t in np.arange(0.5, 0.99, 0.01) if (chosen := rest & (p >= t)).any() and y[chosen].mean() >= precision]
        cuts.append(float(fit[0]) if fit else 0.99)
    return start, trees, tuple(cuts)


def personal_data(docs: DataFrame, train_rows: int = 3000, precision: float = 0.995) -> DataFrame:
    """Per document: doc_id, base (base spans) and spans (all spans), arrays of (kind, start, end).

    Spans are code points, end exclusive, ordered by kind as in KINDS, then start; kind is its index.
    Base spans are the leftmost non-overlapping matches of the fixed patterns that pass their check. The
    trees add candidates whose calibrated probability reaches their kind's threshold and that overlap no
    base span; of overlapping ones the first stays, and the earlier kind of those that start together.
    `train_rows` bounds the made-up texts they are fitted on. Null and empty texts have no spans; a very long
    text is swept, not compared span by span; every row is searched, repeated ones alike; extra columns are
    ignored; an empty table gives no rows. DataFrame functions alone, no shuffle.
    """
    start, trees, cuts = _model(docs.sparkSession, train_rows, precision)
    text = F.col("text")
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.select("doc_id", "text", F.when(text.rlike(r"[0-9@]"), base_spans(text)).otherwise(F.expr("cast(array() as array<struct<kind:int,start:int,end:int>>)")).alias("base"), candidates(text).alias("c"))

    def likely(x: Column) -> Column:
        return let(x["f"], lambda f: 1 / (1 + F.exp(-boosting.column(start, trees, [F.get(f, F.lit(i)) for i in range(len(FEATURES))])))) >= F.get(F.lit(list(cuts)), x["kind"])

    def apart(rows: Column) -> Column:
        """Of base spans and candidates in order of place, the candidates that meet no base span."""
        ended = running(rows, F.lit(-1), lambda at, x: F.when(x["new"], at).otherwise(F.greatest(at, x["end"])))
        begun = F.reverse(running(F.reverse(rows), F.lit(2**31 - 1), lambda at, x: F.when(x["new"], at).otherwise(x["start"])))
        near = F.zip_with(F.zip_with(rows, ended, lambda x, e: F.struct(x.alias("x"), e.alias("ended"))), begun, lambda y, b: F.struct(y["x"].alias("x"), y["ended"].alias("ended"), b.alias("begun")))
        return F.transform(F.filter(near, lambda y: y["x"]["new"] & (y["ended"] <= y["x"]["start"]) & (y["begun"] >= y["x"]["end"])), lambda y: y["x"])

    def first(rows: Column) -> Column:
        """Of candidates in order of place, each that meets none of those before it that stay."""
        ended = running(rows, F.lit(-1), lambda at, x: F.when(x["start"] >= at, x["end"]).otherwise(at))
        return F.transform(F.filter(F.zip_with(rows, ended, lambda x, e: F.struct(x.alias("x"), e.alias("ended"))), lambda y: y["x"]["start"] >= y["ended"]), lambda y: y["x"])

    def span(x: Column, new: bool) -> Column:
        return F.struct(x["start"].alias("start"), F.lit(new).alias("new"), x["kind"].alias("kind"), x["end"].alias("end"))

    def added(picked: Column) -> Column:
        both = F.sort_array(F.concat(F.transform("base", lambda x: span(x, False)), F.transform(picked, lambda x: span(x, True))))
        return F.transform(let(let(both, apart), first), lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end")))

    def all_spans(picked: Column) -> Column:
        return F.when(F.size(picked) == 0, F.col("base")).otherwise(F.sort_array(F.concat("base", added(picked))))

    return rows.select("doc_id", "base", F.when(F.size("c") == 0, F.col("base")).otherwise(let(F.filter("c", likely), all_spans)).alias("spans"))


def _listed(spans: str) -> Column:
    names = F.lit(list(KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")


def digest(found_: DataFrame) -> DataFrame:
    """doc_id, base counts by kind, base_sha256, spans, and of `personal_data` n_added, n_secret and n_spans (all of them)."""

    def count(spans: str, kind: str) -> Column:
        return F.size(F.filter(spans, lambda x: x["kind"] == KINDS.index(kind))).cast("long").alias(f"n_{kind}")

    added = (F.size("spans") - F.size("base")).cast("long").alias("n_added")
    return found_.select("doc_id", *[count("base", k) for k in BASE], F.sha2(_listed("base"), 256).alias("base_sha256"), _listed("spans").alias("spans"), added, count("spans", "secret"), F.size("spans").cast("long").alias("n_spans"))
