"""Surrogates for personal data: keyed, type-consistent and distinct.

Entities are e-mail addresses, phone numbers, card numbers, IPv4 addresses, social
security numbers, and persons (a title or a listed given name before capitalised
words, in Latin, Cyrillic or Greek script). Each distinct entity of the corpus gets
one surrogate that a keyed hash draws, so that all mentions of an entity agree in
all documents. Mentions are of one entity if they have the same digits (phone, card
and social security numbers), letters without regard to case (e-mail addresses), or
name without titles. A single name after a title stands for a full name of the same
document that has it as surname, or else as given name: of several, those of the
title's gender, the last before it or else the first after it. Each mention shows its
entity's surrogate in its own case, separators and title. Surrogates keep the format: the length and kind of every character
of an address, the grouping of digits, the number of digits of each octet, the
check digit of a card number, the country code of a phone number that is written with
``+`` anywhere, and script, gender and case of a name.

A collision check over the whole corpus follows: two entities of one kind may not
share a surrogate, and no surrogate may be an entity itself. All but the first of a
colliding group are drawn again with the next number until none collide. Four draws
keep the format. Who finds nothing free in these gets a wider one, so that the supply
does not end: a letter more in the mailbox, a digit more in a phone, card or social
security number for every further draw, octets of any length for an address, and for
names invented surnames that grow by syllables.

Null text stays null and has no entities. All rows and columns are kept.
"""

from __future__ import annotations

import hashlib
import hmac
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.llm.common import carried, materialise, unpacked


# Names by script and gender: surrogates, and given names that mark a person.
NAMES = {
    ("latin", "f"): "Anna Maria Laura Emma Julia Sophie Clara Elena Nina Alice Sarah Marta Irene Paula Helen Judith Carla Diana Edith Rosa".split(),
    ("latin", "m"): "Paul Peter Martin Thomas David Lucas Simon Oscar Hugo Victor Adam Bruno Carlos Daniel Erik Felix Henry Jonas Leon Robert".split(),
    ("cyrillic", "f"): "Анна Мария Елена Ольга Наталья Ирина Татьяна Светлана Вера Юлия".split(),
    ("cyrillic", "m"): "Иван Пётр Сергей Андрей Дмитрий Николай Павел Олег Юрий Виктор".split(),
    ("greek", "f"): "Μαρία Ελένη Άννα Σοφία Δήμητρα Κατερίνα".split(),
    ("greek", "m"): "Γιώργος Νίκος Γιάννης Πέτρος Ανδρέας Παύλος".split(),
}
SURNAMES = {
    "latin": "Keller Moreau Santos Walker Novak Lindberg Ferrari Dubois Wagner Torres Baker Jansen Rossi Fischer Martel Vidal Hansen Carter Silva Bergman".split(),
    "cyrillic": "Орлов Лебедев Соколов Морозов Волков Зайцев Павлов Козлов".split(),
    "greek": "Παππάς Νικολάου Γεωργίου Δημητρίου Ιωάννου Βασιλείου".split(),
}
SYLLABLES = {"latin": "ba co de fi ga lo ma ne ri su ta vo".split(), "cyrillic": "ба ко де фи га ло ма не ри су".split(), "greek": "βα κο δε φι γα λο μα νε ρι".split()}
TITLES = {"m": r"Mr|Herr|Monsieur|Sr|Señor|Signor", "f": r"Mrs|Ms|Miss|Frau|Mme|Mlle|Madame|Sra|Señora|Signora", "": r"Dr|Prof"}

_GIVEN = {name: (script, gender) for (script, gender), names in NAMES.items() for name in names}
_WORD = r"[A-ZÀ-ÖØ-ÞА-ЯЁΑ-ΩΆΈ-Ώ][a-zß-öø-ÿа-яёα-ωά-ώ]+"
_TITLE = "|".join(TITLES.values())
#: kind and pattern, in order of precedence where matches overlap.
PATTERNS = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"),
    ("ip", r"(?<![\d.])(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)(?:\.(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)){3}(?!\d|\.\d)"),
    ("card", r"(?<![\w+-])\d(?:[ -]?\d){12,18}(?![\w-])"),
    ("ssn", r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])"),
    ("phone", r"(?<!\w)(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)|\d{2,4})[ .-]\d{3,4}[ .-]\d{3,4}(?!\w)|(?<!\w)\+\d{8,14}(?!\w)|(?<!\w)\+\d{1,3}(?:[ .-]\d{2,4}){2,5}(?!\w)"),
    ("person", rf"(?<!\w)(?:(?:(?:{_TITLE})\.? )+{_WORD}|(?:{'|'.join(_GIVEN)})(?= {_WORD}))(?: {_WORD}){{0,2}}(?!\w)"),
]
#: Rows without any of these can hold no entity; the test runs before Python does.
SUSPECT = r"@|[0-9][^A-Za-z]{0,3}[0-9]|\b(?:" + _TITLE + "|" + "|".join(_GIVEN) + r")\b"
_COMPILED = [(kind, re.compile(p)) for kind, p in PATTERNS]
_DIGITS = re.compile(r"\d")
_TITLED = re.compile(rf"((?:(?:{_TITLE})\.? )*)(.*)", re.S)
#: Draws that keep the format of an entity; later ones widen it.
KEEPING = 4
#: Country codes of phone numbers by their first digits.
_COUNTRY = re.compile(r"[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3}")
FOUND = "array<struct<start:int,end:int,kind:string,value:string,entity:string,part:string,hint:string>>"


def entities(text: str) -> list[tuple[int, int, str, str]]:
    """Spans (start, end, kind, text) that do not overlap; earlier kinds come first."""
    taken: list[tuple[int, int, str, str]] = []
    for kind, pattern in _COMPILED:
        found = [(m.start(), m.end(), kind, m[0]) for m in pattern.finditer(text)]
        for start, end, _, _ in found:
            # Later kinds neither see nor reach across what is taken.
            text = text[:start] + "\0" * (end - start) + text[end:]
        taken += found
    return sorted(taken)


def _gender(titles: str) -> str:
    return next((g for g, p in TITLES.items() if g and re.search(rf"(?:^| )(?:{p})\.? ", titles)), "")


def entity(kind: str, value: str) -> tuple[str, str]:
    """What all mentions of an entity have in common, and a hint that only some give: ``+``, or the gender of a title."""
    if kind == "person":
        titles, names = _TITLED.fullmatch(value).groups()
        return names, _gender(titles)
    if kind in ("phone", "card", "ssn"):
        return "".join(_DIGITS.findall(value)), "+" if value.startswith("+") else ""
    return value.lower(), ""


def mentions(text: str) -> list[tuple[int, int, str, str, str, str, str]]:
    """The spans of ``entities`` with entity, part of it that is named (all, first or last) and hint."""
    found = [(*e, *entity(e[2], e[3])) for e in entities(text)]
    full = [(start, name) for start, _, kind, _, name, _ in found if kind == "person" and " " in name]
    out = []
    for start, end, kind, value, name, hint in found:
        part = "all"
        if kind == "person" and " " not in name:
            for at, which in ((-1, "last"), (0, "first")):
                some = [(s, n) for s, n in full if n.split(" ")[at] == name]
                some = [(s, n) for s, n in some if hint and _GIVEN.get(n.split(" ")[0], ("", ""))[1] == hint] or some
                if some:
                    name, part = ([n for s, n in some if s < start] or [some[0][1]])[-1], which
                    break
        out.append((start, end, kind, value, name, part, hint))
    return out


class Draw:
    """A stream of keyed random numbers for one entity and attempt."""

    def __init__(self, key: bytes, kind: str, value: str, attempt: int):
        self.key, self.seed, self.number = key, f"{kind}\0{value}\0{attempt}".encode(), 0

    def __call__(self, n: int) -> int:
        self.number += 1
        return int.from_bytes(hmac.new(self.key, self.seed + self.number.to_bytes(4, "big"), hashlib.sha256).digest()[:8], "big") % n


def _like(text: str, draw: Draw) -> str:
    """Random characters of the same kinds; a leading digit other than 0 stays other than 0."""
    out = []
    for k, c in enumerate(text):
        if c.isdigit():
            low = 1 if c != "0" and (k == 0 or not text[k - 1].isdigit()) else 0
            out.append(str(low + draw(10 - low)))
        elif c.isascii() and c.isalpha():
            out.append(chr((65 if c.isupper() else 97) + draw(26)))
        else:
            out.append(c)
    return "".join(out)


def _luhn(digits: list[int]) -> int:
    return sum(d if k % 2 else (2 * d - 9 * (d > 4)) for k, d in enumerate(reversed(digits))) * 9 % 10


def luhn_holds(digits: list[int]) -> bool:
    return _luhn(digits[:-1]) == digits[-1]


def _digits(text: str, draw: Draw) -> str:
    """Random digits; only 0 becomes 0, so that no separator can make one lead."""
    return "".join(str(draw(10) if c == "0" else 1 + draw(9)) for c in text)


def _person(name: str, gender: str, draw: Draw, attempt: int) -> str:
    names = name.split(" ")
    first = names[0]
    script = "cyrillic" if re.match("[А-яЁё]", first) else "greek" if re.match("[Ά-ώ]", first) else "latin"
    gender = gender or _GIVEN.get(first, ("", ""))[1] or "mf"[draw(2)]
    given = first in _GIVEN or len(names) > 1
    out = [NAMES[script, gender][draw(len(NAMES[script, gender]))]] if given else []
    while len(out) < len(names):
        out.append(SURNAMES[script][draw(len(SURNAMES[script]))])
    if attempt >= KEEPING:
        # More names than the lists have: invented surnames, longer with every round of attempts.
        out[-1] = "".join(SYLLABLES[script][draw(len(SYLLABLES[script]))] for _ in range(2 + attempt // 4)).capitalize()
    return " ".join(out)


def drawn_entity(kind: str, name: str, hint: str, key: bytes, attempt: int = 0) -> str:
    """The surrogate of an entity, in the form of ``entity``."""
    draw = Draw(key, kind, name, attempt)
    more = max(0, attempt - KEEPING + 1)
    if kind == "email":
        box, _, domain = name.partition("@")
        host, _, top = domain.rpartition(".")
        # One domain has one surrogate, whoever writes from it.
        return f"{_like(box + 'a' * more, draw)}@{_like(host, Draw(key, 'domain', host, 0))}.{top}"
    if kind == "ip":
        if more:
            return ".".join(str(1 + draw(255)) for _ in range(4))
        return ".".join(str({1: 1 + draw(9), 2: 10 + draw(90), 3: 100 + draw(156)}[len(o)]) for o in name.split("."))
    if kind == "card":
        old = [int(c) for c in name]
        new = [old[0], *(draw(10) for _ in old[1:]), *(draw(10) for _ in range(more))]
        new[-1] = _luhn(new[:-1]) if luhn_holds(old) else (_luhn(new[:-1]) + 1 + draw(9)) % 10
        return "".join(map(str, new))
    if kind == "person":
        return _person(entity(kind, name)[0], hint or entity(kind, name)[1], draw, attempt)
    country = _COUNTRY.match(name)[0] if hint == "+" else ""
    return country + _digits(name[len(country) :] + "0" * more, draw)


def rendered(kind: str, value: str, part: str, new: str) -> str:
    """An entity's surrogate in the format of a mention."""
    if kind == "person":
        words = new.split(" ")
        return _TITLED.fullmatch(value)[1] + {"all": new, "first": words[0], "last": words[-1]}[part]
    if kind == "email":
        if len(new) != len(value):
            return new.upper() if value.isupper() else new
        return "".join(n.upper() if v.isupper() else n for v, n in zip(value, new, strict=True))
    if kind == "ip":
        return new
    digits = iter(new)
    return _DIGITS.sub(lambda _: next(digits), value) + "".join(digits)


def surrogate(kind: str, value: str, key: bytes, attempt: int = 0) -> str:
    return rendered(kind, value, "all", drawn_entity(kind, *entity(kind, value), key, attempt))


def _find(batches):
    fields = ("start", "end", "kind", "value", "entity", "part", "hint")
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), *((c, pa.string()) for c in ("kind", "value", "entity", "part", "hint"))]))
    for batch in batches:
        found = [[dict(zip(fields, e, strict=True)) for e in mentions(t)] if t else [] for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, kind)], names=[*batch.schema.names, "_found"])


def _name(key: bytes):
    def run(batches):
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("kind", "value", "hint", "attempt")]
            new = pa.array([drawn_entity(k, v, h, key, a) for k, v, h, a in zip(*columns, strict=True)], pa.string())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("kind", "value", "hint", "attempt")), new], names=["kind", "value", "hint", "attempt", "surrogate"])

    return run


def _render(batches):
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("kind", "value", "part", "surrogate")]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("_row", "start", "end", "kind")), pa.array([rendered(*x) for x in zip(*columns, strict=True)], pa.string())], names=["_row", "start", "end", "kind", "surrogate"])


def mapping(found: DataFrame, key: bytes) -> DataFrame:
    """``kind``, ``value``, ``surrogate`` for the distinct entities of ``found`` (with ``hint`` if it has that), checked for collisions."""
    hint = F.col("hint") if "hint" in found.columns else F.lit("")
    every = materialise(found.groupBy("kind", "value").agg(F.max(hint).alias("hint")), "entities")
    todo, done = every.withColumn("attempt", F.lit(0)), None
    while True:
        drawn = materialise(todo.mapInArrow(_name(key), "kind string, value string, hint string, attempt int, surrogate string"), "drawn")
        pool = drawn.withColumn("new", F.lit(1)) if done is None else drawn.withColumn("new", F.lit(1)).unionByName(done.withColumn("new", F.lit(0)))
        # Settled entities keep theirs; among new ones the first by value does.
        first = pool.groupBy("kind", "surrogate").agg(F.min(F.struct("new", "value"))["value"].alias("owner"))
        real = every.select("kind", F.col("value").alias("surrogate"), F.lit(True).alias("real"))
        judged = drawn.join(first, ["kind", "surrogate"]).join(real, ["kind", "surrogate"], "left")
        judged = materialise(judged.select("kind", "value", "hint", "attempt", "surrogate", ((F.col("owner") == F.col("value")) & F.col("real").isNull()).alias("good")), "judged")
        good = judged.where("good").drop("good")
        done = good if done is None else done.unionByName(good)
        left = judged.where("not good")
        if left.isEmpty():
            return done.drop("attempt", "hint")
        todo = left.select("kind", "value", "hint", (F.col("attempt") + 1).alias("attempt"))


def _replaced(text: Column, spans: Column) -> Column:
    def add(state: Column, x: Column) -> Column:
        gap = F.substring(text, state["at"] + 1, x["start"] - state["at"])
        return F.struct(x["end"].alias("at"), F.concat(state["out"], gap, x["surrogate"]).alias("out"))

    done = F.aggregate(spans, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), add)
    return F.concat(done["out"], F.substring(text, done["at"] + 1, F.length(text)))


def replace_entities(docs: DataFrame, key: bytes = b"shelfline") -> DataFrame:
    """``docs`` with surrogates in ``text``, and their number in ``n_entities``; ``key`` should be secret in production.

    All other columns stay as they are; where the table has an ``n_entities`` already, the
    number is called ``n_entities_found``, or that with more lines below.
    """
    count = "n_entities"
    while count in docs.columns:
        count = "n_entities_found" if count == "n_entities" else f"{count}_"
    suspect = F.coalesce(F.col("text").rlike(SUSPECT), F.lit(False))
    rest = docs.where(~suspect).withColumn(count, F.lit(0).cast("long"))
    carrier = carried(docs.where(suspect))
    found = T.StructType([*carrier.schema.fields, *T.StructType.fromDDL(f"_found {FOUND}").fields])
    rows = materialise(carrier.mapInArrow(_find, found).withColumn("_row", F.monotonically_increasing_id()), "suspects")
    each = rows.select("_row", F.explode("_found").alias("e")).select("_row", "e.*")
    names = mapping(each.select("kind", F.col("entity").alias("value"), "hint"), key).withColumnRenamed("value", "entity")
    named = each.join(names, ["kind", "entity"]).mapInArrow(_render, "_row long, start int, end int, kind string, surrogate string")
    spans = named.groupBy("_row").agg(F.array_sort(F.collect_list(F.struct("start", "end", "kind", "surrogate"))).alias("_spans"))
    joined = rows.join(spans, "_row", "left")
    text = F.when(F.col("_spans").isNotNull(), _replaced(F.col("text"), F.col("_spans"))).otherwise(F.col("text"))
    number = F.coalesce(F.size("_spans"), F.lit(0)).cast("long")
    number = F.when(F.col("_spans").isNull(), F.lit(0)).otherwise(number).cast("long")
    return joined.select(*unpacked(docs.columns, text), number.alias(count)).unionByName(rest)


def op5_private_data(spark, sf_dir: str) -> DataFrame:
    """All documents with surrogates for the personal data in their whole texts."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return replace_entities(docs).select("doc_id", "text", "n_entities")
