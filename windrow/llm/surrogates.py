"""Personal data replaced by keyed surrogates.

Each detected entity (mail address, phone, card and account numbers, IP address, secret, named
person) is replaced by another value of its type. The value follows from the key and the entity's
canonical form alone, so one entity gets one surrogate in all texts; each mention keeps its format:
case, separators, script, length of numbers, a valid check digit, a person's gender. A distributed
check finds entities that share a surrogate, or whose surrogate is itself a real entity, and gives
all but one of them the next value, until every entity has its own.

Null texts stay null, texts without entities stay as they are; repeated rows are replaced alike.
Other columns are kept. Empty tables give empty results.
"""

from __future__ import annotations

import hashlib
import hmac
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windrow.llm.components import free_names, written

BROADCAST_TEXTS = 200_000
NEEDS_LOOK = re.compile(r"[@\d]|AKIA|(?:sk|ghp|gho|xox[bp])[-_]|\b(?:M(?:rs?|s|me|lle|iss)|Dr|Herrn?|Frau|Señora?|Sra?|Господин|Госпожа)\b")

# Tried in this order; a later one never takes characters of an earlier find.
PATTERNS: dict[str, re.Pattern] = {
    "email": re.compile(r"[\w.%+-]+@[\w-]+(?:\.[\w-]+)+"),
    "iban": re.compile(r"(?<!\w)[A-Za-z]{2}\d{2}(?: ?[A-Za-z0-9]{4}){3,7}(?: ?[A-Za-z0-9]{1,3})?(?!\w)"),
    "secret": re.compile(r"(?<!\w)(?:(?=[A-Za-z]*\d)[0-9a-f]{32,}|(?=[A-Za-z]*\d)[0-9A-F]{32,}|AKIA[0-9A-Z]{16}|(?:sk|ghp|gho|xox[bp])[-_][A-Za-z0-9_-]{16,})(?!\w)"),
    "ip": re.compile(r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?!\.?\d)"),
    "card": re.compile(r"(?<!\w)\d(?:[ -]?\d){12,18}(?!\w)"),
    "phone": re.compile(r"(?<![\w+.])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{2,4}[ .-])\d{3,4}[ .-]?\d{3,4}(?!\w|\.\d)|(?<!\w)\+\d{9,14}(?!\w)"),
    "ssn": re.compile(r"(?<!\w)\d{3}-\d{2}-\d{4}(?!\w)"),
    "person": re.compile(
        r"\b(?P<title>Mr|Mrs|Ms|Miss|Mme|Mlle|Dr|Herrn?|Frau|Señora?|Sra?|Господин|Госпожа)\b\.? (?P<name>[A-ZÀ-ÞА-Я][\w'-]+(?: [A-ZÀ-ÞА-Я][\w'-]+)?)"
    ),
}
FEMALE = {"mrs", "ms", "miss", "mme", "mlle", "frau", "señora", "sra", "госпожа"}
# Invented people: given names by gender and script, and surnames by script.
GIVEN = {
    ("f", "latin"): ["Alma", "Berta", "Clara", "Dora", "Elsa", "Flora", "Greta", "Hilda", "Irma", "Julia", "Karla", "Lena"],
    ("m", "latin"): ["Albin", "Bruno", "Carl", "Dirk", "Emil", "Franz", "Georg", "Hugo", "Igor", "Jonas", "Kurt", "Leon"],
    ("f", "cyrillic"): ["Анна", "Вера", "Дарья", "Елена", "Зоя", "Инна", "Лидия", "Мария"],
    ("m", "cyrillic"): ["Антон", "Борис", "Виктор", "Глеб", "Денис", "Егор", "Иван", "Кирилл"],
}
SYLLABLES = {"latin": ["bar", "den", "fol", "gar", "hol", "kin", "lor", "mar", "nes", "pol", "ran", "sel", "tor", "ven", "wil", "zan"],
             "cyrillic": ["бар", "вол", "гор", "дан", "зор", "кор", "лан", "мир", "нов", "пол", "ров", "сол", "тар", "фед", "хор", "яр"]}
DIGITS, LETTERS = "0123456789", "abcdefghijklmnopqrstuvwxyz"


def _stream(key: bytes, kind: str, canonical: str, attempt: int) -> Iterator[int]:
    """Endless numbers under 2**32 that only the key's holder can foretell."""
    block = 0
    while True:
        digest = hmac.new(key, f"{kind}|{attempt}|{block}|{canonical}".encode("utf-8", "surrogatepass"), hashlib.sha256).digest()
        for i in range(0, 32, 4):
            yield int.from_bytes(digest[i : i + 4], "big")
        block += 1


def luhn(digits: str) -> bool:
    return sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits))) % 10 == 0


def canonical(kind: str, mention: str) -> str:
    """One form for all mentions of an entity."""
    if kind in ("card", "phone", "ssn"):
        return "".join(c for c in mention if c.isdigit())
    if kind == "iban":
        return mention.replace(" ", "").lower()
    return " ".join(mention.casefold().split())


def surrogate(key: bytes, kind: str, form: str, attempt: int = 0) -> str:
    """The canonical form of the entity's surrogate; never the entity itself."""
    draw = _stream(key, kind, form, attempt)
    while True:
        made = _draw(kind, form, draw, attempt)
        if made != form:
            return made


def _draw(kind: str, form: str, draw: Iterator[int], attempt: int) -> str:
    """Names and mail addresses get longer with each attempt, so that their values never run out."""
    pick = lambda choices: choices[next(draw) % len(choices)]
    if kind == "email":
        name = "".join(pick(DIGITS) if c.isdigit() else c if c in "._%+-" else pick(LETTERS) for c in form.split("@")[0])
        return name + "".join(pick(LETTERS) for _ in range(max(0, 8 - len(name)) + attempt)) + f"@mail{next(draw) % 100}.example.org"
    if kind == "ip":
        return ".".join(str(1 + next(draw) % 254) for _ in range(4))
    if kind == "person":
        _, gender, script, n = form.split("|")[:4] if form.count("|") >= 3 else ("", "m", "latin", "1")
        family = "".join(pick(SYLLABLES[script]) for _ in range(4 + attempt)).capitalize()
        return f"{pick(GIVEN[gender, script])} {family}" if n == "2" else family
    kept = {"phone": max(0, len(form) - 10), "iban": 4}.get(kind, 0)
    rest = form[kept:]
    if kind == "secret" and re.fullmatch(r"[0-9a-f]+", rest):
        return "".join(pick("0123456789abcdef") for _ in rest)
    made = form[:kept] + "".join(pick(DIGITS) if c.isdigit() else c if not c.isalpha() else pick(LETTERS) for c in rest)
    if kind == "card" and luhn(form):
        made = next(made[:-1] + d for d in DIGITS if luhn(made[:-1] + d))
    return made


def mentions(text: str) -> list[tuple[int, int, str, str]]:
    """``start, end, kind, canonical form`` of each entity, in order, without overlaps."""
    if not NEEDS_LOOK.search(text):
        return []
    found: list[tuple[int, int, str, str]] = []
    taken = bytearray(len(text))
    for kind, pattern in PATTERNS.items():
        for m in pattern.finditer(text):
            start, end = m.span("name") if kind == "person" else m.span()
            if kind == "email":
                while text[end - 1] in ".-_":
                    end -= 1
            if any(taken[start:end]) or kind == "ip" and any(int(x) > 255 for x in m[0].split(".")):
                continue
            if kind == "phone" and not 8 <= sum(c.isdigit() for c in m[0]) <= 15:
                continue
            form = canonical(kind, text[start:end])
            if kind == "person":
                gender = "f" if m["title"].lower() in FEMALE else "m"
                script = "cyrillic" if re.search("[А-я]", form) else "latin"
                form = f"{form}|{gender}|{script}|{min(2, len(form.split()))}"
            taken[start:end] = b"\1" * (end - start)
            found.append((start, end, kind, form))
    return sorted(found)


def shaped(kind: str, mention: str, made: str) -> str:
    """The surrogate in the format of one mention."""
    if kind in ("card", "phone", "ssn", "iban"):
        fresh = iter(made)
        made = "".join(next(fresh) if c.isalnum() else c for c in mention)
    if mention.isupper():
        return made.upper()
    if mention.islower():
        return made.lower()
    if kind in ("secret", "iban"):
        fresh = "".join(m.upper() if c.isupper() else m for c, m in zip(mention, made))
        return fresh + made[len(fresh) :]
    return made


def entities(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``text_key, kind, form``: each entity of each text once."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for key, text in zip(batch.column(0), batch.column(1)):
                rows += [(key.as_py(), kind, form) for kind, form in sorted({m[2:] for m in mentions(text.as_py() or "")})]
            columns = list(zip(*rows)) if rows else [(), (), ()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.string())],
                ["text_key", "kind", "form"],
            )

    keyed = docs.select(F.xxhash64(text_col).alias("text_key"), F.col(text_col).alias("text"))
    return keyed.mapInArrow(found, "text_key long, kind string, form string")


def attempts(found: DataFrame, key: bytes, make: Callable[[bytes, str, str, int], str] = surrogate) -> DataFrame:
    """``kind, form, attempt`` of the entities whose first surrogate would collide.

    Every round compares the surrogates of all entities with each other and with all real entities;
    of those that share one, the least form keeps it and the others take their next value.
    """

    @F.arrow_udf("string")
    def made(kinds: pa.Array, forms: pa.Array, tries: pa.Array) -> pa.Array:
        return pa.array([make(key, *(x.as_py() for x in row)) for row in zip(kinds, forms, tries)], pa.string())

    real = found.select("kind", "form").distinct()
    state = written(real.withColumn("attempt", F.lit(0)).withColumn("made", made("kind", "form", F.lit(0))), "surrogates")
    # A person's form carries gender and script behind the name; the name alone is compared.
    names = state.select("kind", F.split_part("form", F.lit("|"), F.lit(1)).alias("name")).distinct()
    while True:
        first = state.groupBy("kind", "made").agg(F.count("*").alias("n"), F.min("form").alias("least"))
        same = first.join(names, (first["kind"] == names["kind"]) & (F.lower("made") == F.col("name")), "left")
        clash = same.where("n > 1 or name is not null").select(
            first["kind"].alias("k"), F.col("made").alias("m"), F.when(F.col("name").isNull(), F.col("least")).alias("winner")
        )
        clash = written(clash, "clashes")
        if clash.isEmpty():
            return state.where("attempt > 0").select("kind", "form", "attempt")
        joined = state.join(clash, (F.col("kind") == F.col("k")) & (F.col("made") == F.col("m")), "left")
        again = F.col("m").isNotNull() & ~F.col("form").eqNullSafe(F.col("winner"))
        moved = joined.select("kind", "form", (F.col("attempt") + again.cast("int")).alias("attempt"), "made", again.alias("again"))
        moved = moved.withColumn("made", F.when(F.col("again"), made("kind", "form", "attempt")).otherwise(F.col("made")))
        state = written(moved.drop("again"), "surrogates")


def replace(docs: DataFrame, key: bytes, text_col: str = "text") -> DataFrame:
    """``docs`` with the entities in ``text_col`` replaced, all else unchanged, in the same columns,
    whatever their names. Texts of any length are read whole."""
    if not key:
        raise ValueError("a secret key is needed")
    found = written(entities(docs, text_col), "entities")
    later = written(attempts(found, key), "attempts")
    rows, tries = docs, F.lit(None).cast("map<string,int>")
    name_key, name_tries = free_names(docs, "text_key", "tries")
    if not later.isEmpty():
        lists = found.join(later, ["kind", "form"]).groupBy("text_key").agg(
            F.map_from_entries(F.collect_set(F.struct(F.concat_ws("|", "kind", "form"), "attempt"))).alias(name_tries)
        )
        lists = written(lists.withColumnRenamed("text_key", name_key), "tries")
        lists = F.broadcast(lists) if lists.count() <= BROADCAST_TEXTS else lists
        rows, tries = docs.join(lists, F.xxhash64(text_col) == F.col(name_key), "left"), F.col(name_tries)

    @F.arrow_udf("string")
    def replaced(texts: pa.Array, known: pa.Array) -> pa.Array:
        out = []
        for text, later in zip(texts, known):
            text, later = text.as_py(), dict(later.as_py() or ())
            parts, at = [], 0
            for start, end, kind, form in mentions(text or ""):
                made = surrogate(key, kind, form, later.get(f"{kind}|{form}", 0))
                parts += [text[at:start], shaped(kind, text[start:end], made)]
                at = end
            out.append("".join(parts) + text[at:] if parts else text)
        return pa.array(out, pa.string())

    return rows.withColumn(text_col, replaced(F.col(text_col), tries)).drop(name_key, name_tries)
