"""Personal data replaced by keyed surrogates of the same kind, script, gender and format."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from hashlib import blake2b
from math import prod

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from savora.llm.text import map_batches, prepare
from savora.session import stage

# Fixed: common given names by script and gender; a name of a list becomes another one of that list.
GIVEN = {
    ("latin", "m"): "James John Robert Michael William David Richard Thomas Charles Daniel Matthew Anthony Mark Paul Steven "
    "Andrew Kevin Brian George Peter Hans Karl Jean Pierre Luis Carlos Juan Pedro",
    ("latin", "f"): "Mary Patricia Jennifer Linda Elizabeth Barbara Susan Jessica Sarah Karen Lisa Nancy Sandra Ashley Emily "
    "Donna Michelle Carol Amanda Laura Anna Julia Marie Claire Maria Carmen Ana Lucia",
    ("cyrillic", "m"): "Иван Дмитрий Сергей Андрей Алексей Михаил Николай Павел",
    ("cyrillic", "f"): "Анна Мария Елена Ольга Наталья Ирина Татьяна Светлана",
}
GENDER_OF = {name: key for key, names in GIVEN.items() for name in names.split()}
# Fixed: what stands before a name, by script.
TITLES = {
    "latin": "Mr Mister Herr Monsieur Sr Señor Mrs Ms Miss Frau Madame Mme Mlle Sra Señora Dr Doctor Prof Professor",
    "cyrillic": "г-н г-на г-ну г-ном г-жа г-жи г-же г-жу г-жой господин господина господину госпожа госпожи госпоже госпожу "
    "гражданин гражданка доктор доктора профессор профессора",
    "greek": "κ κος κα κύριος κύριο κυρία κύριε",
}
# Words inside names that stay.
PARTICLES = "van von der den de del della di da dos das du la le y ten ter zu zur bin ibn af av".split()
# Capitalised words that end a name.
NO_NAME = (
    "The And But Or In On At Of For To From By With He She It They We I You His Her Its Their Our My Your This That These "
    "Those There Then When Where Who What Which Why How If So As Is Was Were Are Has Had Not No Yes Also After Before While "
    "Monday Tuesday Wednesday Thursday Friday Saturday Sunday January February March April June July August September "
    "October November December Он Она Они Это Но И В На Как Что Когда Der Die Das Und Er Sie Le La Les Et Il Elle El Los Las"
).split()

# Letters a surrogate may put in place of one another.
ALPHABETS = (
    "0123456789",
    "abcdefghijklmnopqrstuvwxyz",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "àáâãäåçèéêëìíîïñòóôõöùúûüý",
    "ÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖÙÚÛÜÝ",
    "".join(map(chr, range(0x430, 0x450))),
    "".join(map(chr, range(0x410, 0x430))),
    "".join(map(chr, range(0x3B1, 0x3C2))) + "".join(map(chr, range(0x3C3, 0x3CA))),
    "".join(map(chr, range(0x391, 0x3A2))) + "".join(map(chr, range(0x3A3, 0x3AA))),
)
PLACE = {c: (a, i) for a in ALPHABETS for i, c in enumerate(a)}
HEX = "0123456789abcdef"
ROUNDS = 8

def _either(words: list[str]) -> str:
    """A pattern for any of the words, by first letter; longer ones first."""
    tails: dict[str, list[str]] = {}
    for w in sorted(words, key=lambda w: (-len(w), w)):
        tails.setdefault(w[0], []).append(re.escape(w[1:]))
    return "|".join(f"{first}(?:{'|'.join(rest)})" for first, rest in tails.items())


_LETTER = r"(?:[^\W\d_]|[\u0300-\u036f])"
_CAPITAL = f"[{''.join(c for c in map(chr, range(0x2000)) if c.isupper())}]"
_GAP = r"[ \t\u00a0]{1,2}"
_TITLE = _either([v for t in " ".join(TITLES.values()).split() for v in {t, t[0].upper() + t[1:]}])
_GIVEN = _either([v for n in GENDER_OF for v in (n, n.upper())])
# A capitalised word with its hyphens and apostrophes but for a possessive s, or an initial before another part.
_PART = (
    rf"(?!(?:{_either(NO_NAME)}|{_TITLE})(?!{_LETTER}))"
    rf"(?:{_CAPITAL}\.(?=[ \t\u00a0]{{0,2}}{_CAPITAL})|{_CAPITAL}{_LETTER}*(?:(?!['’]s(?!{_LETTER}))['’\-]{_LETTER}+)*)"
)
_PARTICLES = rf"(?:(?:{_either(PARTICLES)}){_GAP}){{0,3}}"
_NAME = rf"{_PARTICLES}{_PART}(?:(?:{_GAP}|(?<=\.)){_PARTICLES}{_PART}){{0,6}}"
_FIRST = f"[{''.join(sorted({w[0] for w in [*GENDER_OF, *' '.join(TITLES.values()).split()]} | {w[0].upper() for w in ' '.join(TITLES.values()).split()}))}]"
PATTERN = re.compile(
    "|".join(
        (
            r"(?P<email>[A-Za-z0-9._%+\-]+@[A-Za-z0-9\-]+(?:\.[A-Za-z0-9\-]+)+)",
            r"(?:(?i:token|secret|passw(?:or)?d|api[_\-]?key|access[_\-]?key))[\"']?\s*[:=]\s*[\"']?(?P<secret>[A-Za-z0-9+/_\-]{8,})",
            r"\b(?P<hex>[0-9a-fA-F]{32,128})\b",
            r"\b(?P<iban>[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?)\b",
            r"(?<![\d.])(?P<ip>(?:\d{1,3}\.){3}\d{1,3})(?![\d.]*\d)",
            r"(?<!\d)(?P<ssn>\d{3}-\d{2}-\d{4})(?!\d)",
            r"(?<![\d+])(?P<card>\d(?:[ \-]?\d){12,18})(?!\d)",
            r"(?<!\d)(?P<phone>(?:\+\d{1,3}[ .\-]?)?\(?\d{3}\)?[ .\-]\d{3}[ .\-]\d{4}|\+\d{1,3}(?:[ .\-]?\d{2,4}){2,5})(?!\d)",
rf"\b(?={_FIRST})(?:(?:(?:{_TITLE})(?:\.{_GAP}|\.|{_GAP}))+|(?=(?:{_GIVEN})(?!{_LETTER})))(?P<name>{_NAME})",
        )
    )
)
# No text without any of these holds an entity.
HINT = re.compile(rf"[@\d]|(?i:token|secret|passw|key)|\b(?={_FIRST})(?:(?:{_TITLE})[. \t\u00a0]|(?:{_GIVEN})(?!{_LETTER}))")
WORD = re.compile(rf"{_LETTER}+")
MENTION = re.compile(rf"(?<![^\W_]){_CAPITAL}{_LETTER}+")


class Permutation:
    """Keyed permutations of strings by a Feistel network: one round after another adds to one half a keyed
    hash of the other. A permutation maps no two strings to one."""

    def __init__(self, key: bytes, attempt: int):
        self.key = blake2b(key + attempt.to_bytes(4, "big"), digest_size=32).digest()
        # Each list in a keyed order, in which a name becomes the next one and so never stays itself.
        self.given: dict[str, str] = {}
        for names in map(str.split, GIVEN.values()):
            order = sorted(names, key=lambda n: blake2b(n.encode(), key=self.key).digest())
            self.given.update(zip(order, order[1:] + order[:1], strict=True))
        self.word = lru_cache(maxsize=100_000)(self._word)

    def _draw(self, tweak: str, round_: int, value: int, below: int) -> int:
        text = f"{tweak}\0{round_}\0{value}".encode()
        size = (below.bit_length() + 7) // 8 + 8
        out = b"".join(
            blake2b(text + bytes([i]), key=self.key).digest() for i in range(-(-size // 64))
        )
        return int.from_bytes(out[:size], "big") % below

    def numbers(self, values: list[int], sizes: list[int], tweak: str) -> list[int]:
        """A permutation of the tuples with ``0 <= value < size``."""
        return self._rounds(values, sizes, f"{tweak}\0{sizes}", range(ROUNDS), 1)

    def _rounds(self, values: list[int], sizes: list[int], tweak: str, rounds: Iterable[int], sign: int) -> list[int]:
        half = (len(sizes) + 1) // 2
        a, b = _packed(values[:half], sizes[:half]), _packed(values[half:], sizes[half:])
        below_a, below_b = prod(sizes[:half]), prod(sizes[half:])
        for r in rounds:
            if r % 2:
                b = (b + sign * self._draw(tweak, r, a, below_b)) % below_b
            else:
                a = (a + sign * self._draw(tweak, r, b, below_a)) % below_a
        return _unpacked(a, sizes[:half]) + _unpacked(b, sizes[half:])

    def moved(self, values: list[int], sizes: list[int], tweak: str) -> list[int]:
        """A permutation of the tuples that leaves none in its place: there, a step on, and back again."""
        all_ = prod(sizes)
        there = _packed(self.numbers(values, sizes, tweak), sizes)
        step = 1 + self._draw(f"{tweak}\0{sizes}", ROUNDS, 0, max(1, all_ - 1))
        return self._rounds(_unpacked((there + step) % all_, sizes), sizes, f"{tweak}\0{sizes}", range(ROUNDS)[::-1], -1)

    def _word(self, word: str) -> str:
        """A permutation of the words of names, the same for any case: listed given names within their list, others
        among the words of their format, in any place of a name and after any title."""
        if word in PARTICLES:
            return word
        low = "".join(c.lower() if len(c.lower()) == 1 else c for c in word)
        if low.capitalize() in GENDER_OF:
            new = self.given[low.capitalize()]
            return new.upper() if word.isupper() else new
        places = [PLACE.get(c) for c in low]
        sizes = [len(p[0]) for p in places if p]
        if not sizes:
            return word
        values = [p[1] for p in places if p]
        while True:
            values = self.moved(values, sizes, "name")
            new = iter(values)
            made = "".join(p[0][next(new)] if p else c for c, p in zip(low, places, strict=True))
            if made.capitalize() not in GENDER_OF:
                return _recased(made, word)

    def text(self, text: str, tweak: str, alphabet: Callable[[str], tuple[str, int] | None] = PLACE.get) -> str:
        """A permutation of the strings of the same format: each character stays in its alphabet."""
        places = [alphabet(c) for c in text]
        used = [p for p in places if p]
        if not used:
            return text
        new = iter(self.numbers([i for _, i in used], [len(a) for a, _ in used], tweak))
        return "".join(p[0][next(new)] if p else c for c, p in zip(text, places, strict=True))

    def walk(self, text: str, tweak: str, allowed: Callable[[str], bool], alphabet=PLACE.get) -> str:
        """A permutation of the allowed strings: again until one is met."""
        text = self.text(text, tweak, alphabet)
        while not allowed(text):
            text = self.text(text, tweak, alphabet)
        return text


def _packed(values: list[int], sizes: list[int]) -> int:
    n = 0
    for v, s in zip(values, sizes, strict=True):
        n = n * s + v
    return n


def _unpacked(n: int, sizes: list[int]) -> list[int]:
    out = []
    for s in reversed(sizes):
        n, v = divmod(n, s)
        out.append(v)
    return out[::-1]


def luhn(digits: str) -> bool:
    total = sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits)))
    return total % 10 == 0


def _hex_place(c: str) -> tuple[str, int] | None:
    return (HEX, HEX.index(c)) if c in HEX else None


def _recased(new: str, like: str) -> str:
    return "".join(n.upper() if c.isupper() else n for n, c in zip(new, like, strict=True))


def _with_digits(like: str, digits: str, skip: int = 0) -> str:
    """``like`` with its digits, less the first ``skip``, replaced in order."""
    new, seen, out = iter(digits), 0, []
    for c in like:
        seen += c.isdigit()
        out.append(next(new) if c.isdigit() and seen > skip else c)
    return "".join(out)


def entities(text: str) -> Iterator[tuple[int, int, str, str]]:
    """``begin, end, kind, canonical form`` of the entities, from left to right.

    Words of the names that a text holds are names wherever else they stand in it, before and after.
    """
    if not HINT.search(text):
        return
    found = list(_spelled_out(text))
    known = {w.lower() for _, _, kind, canon in found if kind == "name" for w in WORD.findall(canon) if len(w) > 1}
    known.difference_update(PARTICLES)
    if known:
        ends = iter([*found, (len(text), len(text), "", "")])
        begin, end, *_ = next(ends)
        bare = []
        for m in MENTION.finditer(text):
            while end <= m.start() and begin < len(text):
                begin, end, *_ = next(ends)
            if m.end() <= begin and m[0].lower() in known:
                bare.append((m.start(), m.end(), "name", m[0]))
        found = sorted(found + bare)
    yield from found


def _spelled_out(text: str) -> Iterator[tuple[int, int, str, str]]:
    for m in PATTERN.finditer(text):
        kind = group = m.lastgroup
        canon = found = m[kind]
        if kind == "ip" and any(int(x) > 255 for x in found.split(".")):
            continue
        if kind in ("email", "hex"):
            canon = found.lower()
        elif kind == "secret":
            canon = found.lower() if re.fullmatch(r"[0-9a-fA-F]+", found) else found
            kind = "hex" if canon == found.lower() and re.fullmatch(r"[0-9a-f]+", canon) else "secret"
        elif kind in ("card", "ssn", "iban", "phone"):
            canon = re.sub(r"[^0-9A-Za-z+]", "", found)
        elif kind == "ip":
            canon = ".".join(str(int(x)) for x in found.split("."))
        yield m.start(group), m.end(group), kind, canon


def surrogate(p: Permutation, kind: str, canon: str) -> str:
    """The canonical surrogate of an entity in canonical form; no two of a kind have the same."""
    if kind == "email":
        local, _, domain = canon.partition("@")
        head, _, top = domain.rpartition(".")
        return f"{p.text(local, 'local')}@{p.text(head, 'domain')}.{top}"
    if kind == "hex":
        return p.text(canon, "hex", _hex_place)
    if kind == "card" and luhn(canon):
        head = p.text(canon[:-1], "card")
        return head + next(d for d in "0123456789" if luhn(head + d))
    if kind == "card":
        return p.walk(canon, "no card", lambda t: not luhn(t))
    if kind == "ip":
        return ".".join(map(str, p.numbers([int(x) for x in canon.split(".")], [256] * 4, "ip")))
    if kind == "phone":
        # The country code stays.
        code = len(canon) - 10 if canon.startswith("+") and len(canon) > 11 else 0
        return canon[:code] + p.text(canon[code:], "phone")
    if kind == "iban":
        return canon[:2] + p.text(canon[2:], "iban")
    if kind == "name":
        return WORD.sub(lambda m: p.word(m[0]), canon)
    return p.text(canon, kind)


def shaped(new: str, kind: str, found: str) -> str:
    """The canonical surrogate in the case and with the separators of the entity as it was found."""
    if kind in ("email", "hex"):
        return _recased(new, found)
    if kind in ("card", "ssn", "phone", "iban"):
        parts = iter(re.sub(r"\+", "", new))
        return "".join(next(parts) if c.isalnum() else c for c in found)
    return new


def replaced(text: str, p: Permutation) -> tuple[str, int]:
    out, at, n = [], 0, 0
    for begin, end, kind, canon in entities(text):
        out += [text[at:begin], shaped(surrogate(p, kind, canon), kind, text[begin:end])]
        at, n = end, n + 1
    return "".join([*out, text[at:]]) if n else text, n


@lru_cache(maxsize=4)
def _permutation(key: bytes, attempt: int) -> Permutation:
    return Permutation(key, attempt)


def entity_table(docs: DataFrame, *, text_col: str = "text") -> DataFrame:
    """``kind, entity, n``: the distinct entities of all texts and how often each occurs."""
    prepare(docs.sparkSession)

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [(k, c) for t in batch.column(0).to_pylist() if t for _, _, k, c in entities(t)]
        columns = zip(*found, strict=True) if found else ((), ())
        return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], ["kind", "entity"])

    rows = map_batches(docs.select(docs[text_col].cast("string")), make, "kind string, entity string")
    return rows.groupBy("kind", "entity").agg(F.count("*").alias("n"))


def collisions(table: DataFrame, key: bytes, attempt: int) -> DataFrame:
    """``kind, surrogate``: surrogates that two entities of a kind would share, or that are their entity."""

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        p = _permutation(key, attempt)
        made = [surrogate(p, *row) for row in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(made)], ["kind", "entity", "surrogate"])

    made = map_batches(table.select("kind", "entity"), make, "kind string, entity string, surrogate string")
    # An entity without a character to replace has no other form.
    same = (F.col("entity") == F.col("surrogate")) & F.col("entity").rlike("[0-9A-Za-z]{4}")
    return made.distinct().groupBy("kind", "surrogate").agg(
        F.count_distinct("entity").alias("entities"), F.max(same.cast("int")).alias("same")
    ).where("entities > 1 or same = 1").select("kind", "surrogate")


def with_surrogates(
    docs: DataFrame, key: bytes, *, text_col: str = "text", length_col: str | None = "n_chars",
    count_col: str = "n_entities", attempts: int = 8,
) -> DataFrame:
    """``docs`` with the entities of each text replaced, and their number in ``count_col``.

    Entities are e-mail and IP addresses, phone, card, account and social security numbers, secrets, and
    names: those after a title, those that begin with a listed given name, and the words of both wherever else
    they stand in the text. Names of other given names without a title anywhere in the text, and inflected forms, are
    not recognised. The same entity always gets the same surrogate under a key, whatever its case and separators, and
    so does each word of a name; a listed given name keeps its gender and script, all else its format. Distinct entities have
    distinct surrogates: these are permutations, and the entities of all documents are checked for any two
    that share one, or any that stays itself, in which case the next permutation is tried. All rows and columns
    pass through, ``length_col`` (if there is one) is set to the new length of changed texts. A null text
    stays null, with no entities.
    """
    prepare(docs.sparkSession)
    if count_col in docs.columns:
        raise ValueError(f"there is a column {count_col} already")
    table = stage(entity_table(docs, text_col=text_col), "entities")
    attempt = next((a for a in range(attempts) if collisions(table, key, a).isEmpty()), None)
    if attempt is None:
        raise ValueError(f"{attempts} permutations left two entities alike or one unchanged; use another key")
    text_at = docs.columns.index(text_col)
    length_at = docs.columns.index(length_col) if length_col in docs.columns else None

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        p = _permutation(key, attempt)
        rows = batch.column(text_at).to_pylist()
        made = [(None, 0) if t is None else replaced(t, p) for t in rows]
        arrays = batch.columns
        arrays[text_at] = pa.array([t for t, _ in made], batch.column(text_at).type)
        if length_at is not None:
            old = batch.column(length_at)
            sizes = [len(t) if n else size for (t, n), size in zip(made, old.to_pylist(), strict=True)]
            arrays[length_at] = pa.array(sizes, pa.int64()).cast(old.type)
        return pa.RecordBatch.from_arrays([*arrays, pa.array([n for _, n in made], pa.int64())], [*batch.schema.names, count_col])

    return map_batches(docs, make, docs.withColumn(count_col, F.lit(0).cast("long")).schema)
