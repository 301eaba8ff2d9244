"""Personal data replaced by keyed surrogates of the same type and form.

Every entity (kind and canonical value) gets one surrogate in the whole corpus, from a keyed hash:
equal entities stay equal, different ones stay different, and no surrogate is an entity that occurs.
The first candidate of each entity is checked against all entities and all other surrogates by
joins; those that collide take their next candidate and are checked again.
"""

from __future__ import annotations

import hashlib
import hmac
import ipaddress
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from kolumna.llm.common import map_batches, saved, sealed

#: Collisions left after so many rounds are an error: the surrogates of a kind are used up.
MAX_ROUNDS = 40

# Titles by gender of the bearer.
MALE = "Mr|Herr|Monsieur|Señor|Sr|Signor|Don|Sir|г-н|господин|Господин"
FEMALE = "Mrs|Ms|Miss|Frau|Madame|Mme|Mlle|Señora|Señorita|Sra|Srta|Signora|Doña|Lady|г-жа|госпожа|Госпожа"
NEUTRAL = "Dr|Prof|Professor|Mx"

_NAME = r"[^\W\d_]*[A-ZÀ-ÖØ-ÞΑ-ΩА-ЯЁ][^\W\d_]+(?:[-'’][^\W\d_]+)*"
_EMAIL = r"(?P<email>(?<![A-Za-z0-9._%+-])[A-Za-z0-9](?:[A-Za-z0-9._%+-]{0,62}[A-Za-z0-9_%+-])?@(?:[A-Za-z0-9-]{1,63}\.)+[A-Za-z]{2,24}(?![A-Za-z0-9]))"
_IBAN = r"(?P<iban>\b[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?\b)"
_IP6 = r"(?P<ip6>(?<![\w:])(?:[0-9A-Fa-f]{1,4}:){3,7}(?::?[0-9A-Fa-f]{1,4}){1,4}(?![\w:]))"
_IP4 = r"(?P<ip4>(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\.?\d))"
_SSN = r"(?P<ssn>(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-]))"
_CARD = r"(?P<card>(?<![\d.,-])\d(?:[\x20-]?\d){12,18}(?![\d]))"
_PHONE = (
    r"(?P<phone>(?<![\w.])(?:\+\d{1,3}[\x20.-]?(?:\(\d{1,4}\)|\d{1,4})(?:[\x20./-]?\d{2,4}){2,4}"
    r"|\(\d{3}\)\x20?\d{3}[\x20.-]\d{4}|\d{3}[.-]\d{3}[.-]\d{4})(?![\w-]))"
)
_PERSON = rf"(?P<person>\b(?P<title>{MALE}|{FEMALE}|{NEUTRAL})\.?\x20(?P<names>{_NAME}(?:\x20{_NAME}){{0,2}})|(?P<han>[一-鿿]{{1,2}})(?P<hantitle>先生|女士|小姐))"
ENTITY = re.compile("|".join((_EMAIL, _IBAN, _IP6, _IP4, _SSN, _CARD, _PHONE)), re.ASCII)
PERSON = re.compile(_PERSON)
#: A text without any of these holds no entity.
HINT = re.compile(rf"[0-9@]|\b(?:{MALE}|{FEMALE}|{NEUTRAL})\b|先生|女士|小姐")
_GENDER = {**dict.fromkeys([*MALE.split("|"), "先生"], "male"), **dict.fromkeys([*FEMALE.split("|"), "女士", "小姐"], "female")}

#: Kinds of the parts of a name: given names by the gender of the title before them, and the last name.
NAME_KINDS = {"male", "female", "neutral", "family"}
_VOTES = {"male": 1, "female": -1}

# Sounds of invented names.
_SOUNDS = {
    "latin": ("b d f g h j k l m n p r s t v w z br dr gr kl st tr".split(), "a e i o u".split(), ("n", "r", "s", "k"), ("a", "ia", "e", "ina")),
    "cyrillic": ("б в г д ж з к л м н п р с т ф х".split(), "а е и о у".split(), ("н", "р", "в", "к"), ("а", "ия", "на", "ра")),
    "greek": ("β γ δ ζ θ κ λ μ ν π ρ σ τ φ".split(), "α ε η ι ο".split(), ("ος", "ης", "ων", "ας"), ("α", "η", "ια", "ω")),
}
_HAN = "赵钱孙李周吴郑王冯陈褚卫蒋沈韩杨朱秦尤许何吕施张孔曹严华金魏陶姜"


class Keyed:
    """Numbers from a keyed hash of an entity and an attempt."""

    def __init__(self, key: bytes, *names: str):
        self.key, self.names, self.turn, self.left = key, "\0".join(names).encode(), 0, b""

    def below(self, n: int) -> int:
        if len(self.left) < 8:
            self.left = hmac.new(self.key, self.names + b"\0%d" % self.turn, hashlib.sha256).digest()
            self.turn += 1
        value, self.left = int.from_bytes(self.left[:8], "big"), self.left[8:]
        return value % n


def script_of(text: str) -> str:
    name = unicodedata.name(next((c for c in text if c.isalpha()), "a"), "LATIN")
    return next((s for s in ("cyrillic", "greek", "cjk") if name.startswith(s.upper())), "latin")


def luhn_digit(digits: str) -> str:
    total = sum(sum(divmod(int(d) * (2 if i % 2 == 0 else 1), 10)) for i, d in enumerate(reversed(digits)))
    return str(-total % 10)


def iban_check(country: str, account: str) -> str:
    return f"{98 - int(''.join(str(int(c, 36)) for c in account + country + '00')) % 97:02d}"


def canonical(kind: str, value: str) -> str | None:
    """The value that all forms of an entity share; None if it is no entity after all."""
    if kind == "email":
        return value.lower()
    if kind in ("ip4", "ip6"):
        try:
            return ipaddress.ip_address(value).exploded.lower() if kind == "ip6" else ".".join(str(int(x)) for x in value.split("."))
        except ValueError:
            return None
    if kind == "iban":
        plain = value.replace(" ", "")
        return plain if 15 <= len(plain) <= 34 and plain[2:4] == iban_check(plain[:2], plain[4:]) else None
    digits = re.sub(r"\D", "", value)
    if kind == "phone":
        return digits[1:] if len(digits) == 11 and digits[0] == "1" else digits if 7 <= len(digits) <= 15 else None
    return digits


def entity_kind(kind: str) -> str:
    """All parts of names are one kind: a name has one surrogate, whatever title or place it stands in."""
    return "name" if kind in NAME_KINDS else kind


def invented(kind: str, value: str, key: bytes, attempt: int, gender: str | None = None) -> str:
    """The ``attempt``-th candidate for an entity, in canonical form and of the same shape; a name ends by ``gender``."""
    draw = Keyed(key, kind, value, str(attempt))
    alike = lambda c: str(draw.below(10)) if c.isdigit() else chr(97 + draw.below(26)) if "a" <= c <= "z" else chr(65 + draw.below(26)) if "A" <= c <= "Z" else c
    if kind == "email":
        local, _, domain = value.partition("@")
        host = Keyed(key, "domain", domain, "0")  # addresses at one host stay at one host
        labels = ["".join(str(host.below(10)) if c.isdigit() else chr(97 + host.below(26)) if c.isalpha() else c for c in x) for x in domain.split(".")[:-1]]
        extra = "" if attempt == 0 else str(attempt)
        return "".join(map(alike, local)) + extra + "@" + ".".join(labels) + ".example"
    if kind == "ip4":  # the reserved block
        return ".".join([str(240 + draw.below(15)), *(str(draw.below(256)) for _ in range(3))])
    if kind == "ip6":  # the block for documentation
        return ipaddress.ip_address((0x20010DB8 << 96) + (draw.below(1 << 48) << 48) + draw.below(1 << 48)).exploded
    if kind == "iban":
        account = "".join(alike(c) for c in value[4:])
        return value[:2] + iban_check(value[:2], account) + account
    if kind == "card":
        body = value[0] + "".join(str(draw.below(10)) for _ in value[1:-1])
        valid = luhn_digit(value[:-1]) == value[-1]
        return body + (luhn_digit(body) if valid else str((int(luhn_digit(body)) + 1 + draw.below(9)) % 10))
    if kind in ("ssn", "phone"):
        return "".join(str(2 + draw.below(8)) if i == 0 and c != "0" else str(draw.below(10)) for i, c in enumerate(value))
    script = script_of(value)
    if script == "cjk":
        return "".join(_HAN[draw.below(len(_HAN))] for _ in range(max(1, len(value)) + (attempt > 3)))
    starts, vowels, male, female = _SOUNDS[script]
    sounds = "".join(starts[draw.below(len(starts))] + vowels[draw.below(len(vowels))] for _ in range(2 + draw.below(2) + attempt // 4))
    ends = male if gender == "male" else female if gender == "female" else male + female
    return sounds + ends[draw.below(len(ends))]


def rendered(kind: str, value: str, form: str, surrogate: str) -> str:
    """``surrogate`` of the entity ``value`` in the form in which it stands."""
    if kind in ("phone", "card", "ssn", "iban"):
        marks = [i for i, c in enumerate(form) if c.isalnum()]
        out = list(form)
        for i, c in zip(marks[-len(surrogate) :], surrogate[-len(marks) :]):
            out[i] = c
        return "".join(out)
    if form.isupper() and len(form) > 1:
        return surrogate.upper()
    return surrogate[:1].upper() + surrogate[1:] if form[:1].isupper() and kind != "email" else surrogate


def entities(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, canonical value) of the entities of a text in order, none overlapping.

    Names found behind a title are entities wherever the text repeats them with a capital letter.
    """
    if not HINT.search(text):
        return []
    found = [(m.start(), m.end(), m.lastgroup, v) for m in ENTITY.finditer(text) if (v := canonical(m.lastgroup, m.group())) is not None]
    names: dict[str, str] = {}
    people: list[tuple[int, int, str, str]] = []
    for m in PERSON.finditer(text):
        if m.group("han"):
            people.append((m.start("han"), m.end("han"), "family", m.group("han")))
            continue
        parts = list(re.finditer(r"[^\s'’-]+", m.group("names")))
        gender = _GENDER.get(m.group("title"), "neutral")
        last = max(p.start() for p in parts if p.start() == 0 or m.group("names")[p.start() - 1] == " ")
        for p in parts:
            kind = "family" if p.start() >= last else gender
            names.setdefault(p.group().lower(), kind)
            at = m.start("names") + p.start()
            people.append((at, at + len(p.group()), names[p.group().lower()], p.group().lower()))
    if names:
        known = "|".join(re.escape(n) for n in sorted(names, key=len, reverse=True) if len(n) > 2)
        if known:
            for m in re.finditer(rf"\b(?:{known})\b", text, re.IGNORECASE):
                if m.group()[0].isupper():
                    people.append((m.start(), m.end(), names.get(m.group().lower(), "family"), m.group().lower()))
    result, reach = [], 0
    for one in sorted(set(found + people), key=lambda x: (x[0], -x[1], x[2])):
        if one[0] >= reach:
            result.append(one)
            reach = one[1]
    return result


def surrogate_table(known: DataFrame, key: bytes) -> DataFrame:
    """(kind, value, surrogate) for distinct entities ``known`` (kind, value, gender)."""
    schema = "kind string, value string, surrogate string"

    def candidates(rows: DataFrame, attempt: int) -> DataFrame:
        def of(batch: pa.RecordBatch) -> dict:
            kinds, values, genders = (column.to_pylist() for column in batch.columns)
            return {"kind": kinds, "value": values, "surrogate": [invented(k, v, key, attempt, g) for k, v, g in zip(kinds, values, genders)]}

        return map_batches(rows.select("kind", "value", "gender"), of, schema)

    names = known.select(F.col("kind").alias("k"), F.col("value").alias("v"))
    accepted: DataFrame | None = None
    left = known
    for attempt in range(MAX_ROUNDS):
        new = candidates(left, attempt)
        first = new.groupBy("kind", "surrogate").agg(F.min("value").alias("value"))  # of equal candidates one may stay
        first = first.join(names, (F.col("kind") == F.col("k")) & (F.col("surrogate") == F.col("v")), "left_anti")
        if accepted is not None:
            taken = accepted.select(F.col("kind").alias("k"), F.col("surrogate").alias("s"))
            first = first.join(taken, (F.col("kind") == F.col("k")) & (F.col("surrogate") == F.col("s")), "left_anti")
        first = saved(first.select("kind", "value", "surrogate"), "surrogates")
        accepted = first if accepted is None else accepted.unionByName(first)
        left = saved(left.join(first, ["kind", "value"], "left_anti"), "collisions")
        if left.isEmpty():
            return accepted
    raise RuntimeError(f"surrogates still collide after {MAX_ROUNDS} rounds")


def replaced(docs: DataFrame, key: str, text_column: str = "text", n: str = "n_entities", spans: str = "spans") -> DataFrame:
    """``docs`` with surrogates in ``text``, the number of replaced entities and their places in the
    old text (kind:start:end, code points).

    A name keeps its surrogate behind any title and without one; its gender is that of most documents' titles
    before it. Texts without an entity stay as they are, null stays null. Repeated rows and values get the same
    surrogates wherever they stand; an empty table stays empty; columns with a result's name are
    replaced. Surrogates depend on the key and the entity, and on other entities only after a collision.
    """
    secret = key.encode()
    docs, inner, opened = sealed(docs, n, spans)
    text_column = inner[text_column]
    columns, at = docs.columns, docs.columns.index(text_column)
    # Rows that share a hash share their entities: a value's surrogate is the same in all rows anyway.
    # The other columns only keep copies of one text apart, so that they do not meet in one task.
    row_key = F.xxhash64(*[c for c in columns if not docs.schema[c].dataType.simpleString().startswith(("map", "variant"))])

    def found(batch: pa.RecordBatch) -> dict:
        rows = [(k, entity_kind(kind), value, _VOTES.get(kind, 0)) for k, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for kind, value in {e[2:] for e in entities(text or "")}]
        return {name: [r[i] for r in rows] for i, name in enumerate(("row", "kind", "value", "vote"))}

    keyed = docs.withColumn("__row", row_key)
    mentions = saved(map_batches(keyed.select("__row", F.col(text_column).cast("string")), found, "row long, kind string, value string, vote int").distinct(), "mentions")
    votes = F.sum("vote")
    gender = F.when(votes > 0, "male").when(votes < 0, "female").alias("gender")
    table = surrogate_table(saved(mentions.groupBy("kind", "value").agg(gender), "entities"), secret)
    chosen = mentions.select("row", "kind", "value").distinct().join(table, ["kind", "value"]).groupBy("row").agg(F.collect_list(F.struct("kind", "value", "surrogate")).alias("__chosen"))
    joined = keyed.join(chosen.withColumnRenamed("row", "__r"), F.col("__row") == F.col("__r"), "left").select(*columns, "__chosen")
    schema = StructType([*docs.schema.fields, *StructType.fromDDL(f"`{n}` long, `{spans}` string").fields])

    def rewrite(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, counts, places = [], [], []
            for text, table_of in zip(batch.column(at).to_pylist(), batch.column(len(columns)).to_pylist()):
                known = {(c["kind"], c["value"]): c["surrogate"] for c in table_of or ()}
                every = entities(text) if known else []
                out, reach = [], 0
                for start, end, kind, value in every:
                    out += [text[reach:start], rendered(kind, value, text[start:end], known[entity_kind(kind), value])]
                    reach = end
                texts.append(text if not every else "".join(out) + text[reach:])
                counts.append(len(every))
                places.append(",".join(f"{k}:{s}:{e}" for s, e, k, _ in every))
            arrays = [*batch.columns[: len(columns)], pa.array(counts, pa.int64()), pa.array(places, pa.string())]
            arrays[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(arrays, names=[*columns, n, spans])

    return opened(joined.mapInArrow(rewrite, schema), n, spans)
