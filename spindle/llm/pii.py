"""Surrogates for personal data.

Entities are found by patterns: e-mail addresses, telephone numbers, IPv4
addresses, card and account numbers, social security numbers, IBANs, access
keys, passwords and tokens, and names after a title or a known first name.
Each gets a surrogate of its own type, drawn by a keyed hash (HMAC) of its
type, canonical form and a draw number:

* letters become letters of the same case, digits digits, the rest stays;
* card numbers keep their check digit's validity, IBANs theirs, IPv4
  addresses stay addresses, telephone numbers keep the country code, e-mail
  addresses their top-level domain, and all addresses of one domain share
  the surrogate domain;
* names are replaced part by part, so that all mentions of a surname agree;
  the parts keep gender (title or first name), script and case.

Equal entities get equal surrogates in the whole table (coreference).  The
distinct entities are a table; a check finds surrogates that two entities
drew, or that are entities of the corpus themselves, and those entities draw
again until none is left, so distinct entities stay distinct.  Entities of
the first draw need no lookup when texts are rewritten; the few others are
broadcast if their table is small and joined to their texts if not.
"""

from __future__ import annotations

import hashlib
import hmac
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindle.llm.base import bounded_batches, received, shared, written

#: Largest number of redrawn entities that is broadcast (beyond: a join by text).
BROADCAST_REDRAWN = 50_000
KEY = b"surrogate-key"

_PATTERNS = [
    ("email", r"[A-Za-z0-9._%+\-]+@[A-Za-z0-9\-]+(?:\.[A-Za-z0-9\-]+)+"),
    ("aws_key", r"\bAKIA[0-9A-Z]{16}\b"),
    ("iban", r"\b[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}\b"),
    ("secret", r"(?i:\b(?:password|passwd|pwd|token|secret|api[_\-]?key))\s*[=:]\s*[\"']?([^\s\"',;]{6,})"),
    ("phone", r"(?<![\w+])\+[0-9]{1,3}[ .\-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})(?:[ .\-]?[0-9]{2,4}){2,4}(?![0-9])"),
    ("phone", r"(?<![\w(])\([0-9]{3}\) ?[0-9]{3}[ .\-][0-9]{4}(?![0-9])"),
    ("ssn", r"(?<![\w\-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w\-])"),
    ("phone", r"(?<![\w.\-])[0-9]{3}[.\-][0-9]{3}[.\-][0-9]{4}(?![0-9])"),
    ("ip", r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?!\.?[0-9])"),
    ("card", r"(?<![0-9])[0-9](?:[ \-]?[0-9]){12,18}(?![0-9])"),
    ("hex", r"\b[0-9a-f]{32,64}\b"),
]
_FINDERS = [(kind, re.compile(p)) for kind, p in _PATTERNS]
_NEEDED = {"email": "@", "aws_key": "AKIA"}

# Titles and common first names by gender.
_TITLES = {"m": "Mr Herr Monsieur Señor Sr Don господин", "f": "Mrs Ms Miss Frau Madame Mme Señora Sra Doña госпожа",
           "x": "Dr Prof"}
_FIRST = {"m": "James John Robert Michael William David Richard Thomas Charles Hans Peter Klaus Jürgen Pierre Jean Jacques "
               "José Juan Carlos Miguel Иван Алексей Дмитрий Сергей",
          "f": "Mary Patricia Jennifer Linda Elizabeth Barbara Susan Sarah Karen Ursula Monika Petra Marie Isabelle "
               "María Carmen Lucía Анна Мария Ольга Елена"}
_TITLE_OF = {t: g for g, ts in _TITLES.items() for t in ts.split()}
_FIRST_OF = {n: g for g, ns in _FIRST.items() for n in ns.split()}
_WORD = r"[A-ZÀ-ÖØ-ÞА-Я][a-zß-öø-ÿа-яё]+(?:-[A-ZÀ-ÖØ-ÞА-Я][a-zß-öø-ÿа-яё]+)?"
_NAME = re.compile(r"\b(?:(?P<title>" + "|".join(_TITLE_OF) + r")\.?[ ]+(?P<a>" + _WORD + r")(?:[ ]+(?P<b>" + _WORD + r"))?|(?P<c>"
                   + "|".join(_FIRST_OF) + r")[ ]+(?P<d>" + _WORD + r"))\b")

# Syllables and endings that surrogate names are made of, by script.
_SYLLABLES = {"latin": "ba be bo da de do fa fe ga go ha he ja jo ka ke ko la le lo ma me mo na ne no pa pe ra re ro sa se so ta te to va ve".split(),
              "cyrillic": "ба бе бо ва ве во га го да де до за зо ка ке ко ла ле ло ма ме мо на не но па по ра ре ро са се со та те то".split()}
_ENDS = {("latin", "m"): "rn l n s rd".split(), ("latin", "f"): "na la ria ne ssa".split(),
         ("latin", "x"): "r n l m t".split(), ("latin", "last"): "son mann er ez ard".split(),
         ("cyrillic", "m"): "н р м л й".split(), ("cyrillic", "f"): "на ла ра ся ня".split(),
         ("cyrillic", "x"): "н р м л к".split(), ("cyrillic", "last"): "енко ко чук ян ич".split()}


def _luhn(digits: str) -> int:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10


def _iban_ok(text: str) -> bool:
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97 == 1


_ALPHANUMERIC = "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Texts with fewer letters and digits are replaced as a whole.
SHORT = 4
#: Draws of one format before the next one is a character (or syllable) longer.
GROWS = 4

# First letter and number of letters of the ranges that a
# surrogate letter is drawn from (the range of the letter it replaces).
_LETTERS = [(0x41, 26), (0x61, 26), (0x391, 17), (0x3B1, 25), (0x410, 32), (0x430, 32), (0x5D0, 27), (0x627, 20),
            (0x3041, 86), (0x30A1, 90), (0x4E00, 20902), (0xAC00, 11172)]


class _Draws:
    """Bytes of HMAC(key, type, canonical form, draw)."""

    def __init__(self, key: bytes, kind: str, form: str, draw: int):
        self.seed, self.at, self.left = f"{kind}\0{form}\0{draw}".encode("utf-8", "surrogatepass"), 0, b""
        self.key = key

    def below(self, n: int) -> int:
        if len(self.left) < 4:
            self.left += hmac.new(self.key, self.seed + b"\0%d" % self.at, hashlib.sha256).digest()
            self.at += 1
        x, self.left = int.from_bytes(self.left[:4], "big"), self.left[4:]
        return x % n

    def like(self, text: str) -> str:
        """Another text of the same format: digits for digits, letters of the
        same script and case for letters, the rest as it is."""
        out = []
        for c in text:
            if c.isdecimal():
                out.append(str(self.below(10)))
            elif c.isalpha():
                low, n = next((x for x in _LETTERS if x[0] <= ord(c) < x[0] + x[1]), (65 if c.isupper() else 97, 26))
                out.append(chr(low + self.below(n)))
            else:
                out.append(c)
        return "".join(out)

    def text(self, n: int) -> str:
        """``n`` letters and digits."""
        return "".join(_ALPHANUMERIC[self.below(len(_ALPHANUMERIC))] for _ in range(n))


def find_entities(text: str) -> list[tuple[int, int, str]]:
    """``(start, end, type)`` of the entities of a text, in order and apart."""
    found: list[tuple[int, int, str]] = []
    digits = any(d in text for d in "0123456789")
    for kind, finder in _FINDERS:
        if kind in _NEEDED and _NEEDED[kind] not in text or not digits and kind not in ("email", "secret"):
            continue
        for m in finder.finditer(text):
            span = m.span(1) if finder.groups else m.span()
            if kind == "ip" and any(int(x) > 255 for x in m[0].split(".")):
                continue
            if kind == "iban" and not _iban_ok(m[0]):
                continue
            found.append((*span, kind))
    for m in _NAME.finditer(text):
        gender = _FIRST_OF.get(m["a"] or m["c"]) or _TITLE_OF.get(m["title"], "x")
        parts = [("a", "first" if m["b"] else "last"), ("b", "last")] if m["a"] else [("c", "first"), ("d", "last")]
        for group, role in parts:
            if m[group]:
                found.append((*m.span(group), f"name_{gender}" if role == "first" else "name_last"))
    order = {kind: i for i, (kind, _) in reversed(list(enumerate(_PATTERNS)))}
    found.sort(key=lambda f: (f[0], order.get(f[2], 99), -f[1]))
    out, last = [], 0
    for start, end, kind in found:
        if start >= last:
            out.append((start, end, kind))
            last = end
    return out


def canonical(kind: str, text: str) -> str:
    if kind in ("phone", "card", "ssn"):
        return re.sub(r"[^0-9+]", "", text)
    return text.lower() if kind == "email" or kind.startswith("name") else text


def _name(draws: _Draws, kind: str, form: str, more: int = 0) -> str:
    script = "cyrillic" if re.search("[а-яё]", form) else "latin"
    role = kind.split("_")[1]
    parts = [draws.below(len(_SYLLABLES[script])) for _ in range(3 + more)]
    ends = _ENDS[script, role]
    return "".join(_SYLLABLES[script][p] for p in parts) + ends[draws.below(len(ends))]


def surrogate(kind: str, form: str, key: bytes, draw: int = 0) -> str:
    """Surrogate of a canonical form, itself in canonical form.  After every
    ``GROWS`` draws the format has one more character, so that a free surrogate
    exists however many entities there are."""
    draws, more = _Draws(key, kind, form, draw), draw // GROWS
    if kind.startswith("name"):
        return _name(draws, kind, form, more)
    if kind == "email":
        local, _, domain = form.rpartition("@")
        host, _, top = domain.rpartition(".")
        return f"{draws.like(local)}{draws.like('0' * more)}@{_Draws(key, 'domain', domain, 0).like(host)}.{top}"
    if kind == "ip":
        low, span = ({1: 1, 2: 10, 3: 100}, {1: 9, 2: 90, 3: 155}) if not more else ({1: 1, 2: 1, 3: 1}, {1: 254, 2: 254, 3: 254})
        return ".".join(str(low[len(x)] + draws.below(span[len(x)])) for x in form.split("."))
    if kind == "phone":
        keep = min(len(form) - 7, 2 if form.startswith("+") else 0)
        return form[:keep] + draws.like(form[keep:] + "0" * more)
    if kind == "card":
        body = draws.like(form + "0" * more)
        if body and _luhn(form) == 0:
            body = body[:-1] + next(c for c in "0123456789" if _luhn(body[:-1] + c) == 0)
        return body
    if kind == "iban":
        rest = draws.like(form[4:] + "0" * more)
        check = 98 - int("".join(str(int(c, 36)) for c in rest + form[:2] + "00")) % 97
        return f"{form[:2]}{check:02d}{rest}"
    if kind == "aws_key":
        return "AKIA" + draws.like(form[4:] + "0" * more)
    if kind == "hex" or re.fullmatch(r"[0-9a-f]+", form):
        return "".join("0123456789abcdef"[draws.below(16)] for _ in range(len(form) + more))
    if sum(c.isalnum() for c in form) < SHORT:             # symbols: nothing of them may stay
        return draws.text(len(form) + more)
    return draws.like(form + "0" * more)


def dressed(kind: str, new: str, text: str) -> str:
    """The canonical surrogate in the written form of ``text``."""
    if kind in ("phone", "card", "ssn"):
        rest = iter(new.lstrip("+"))
        return "".join(next(rest) if c.isdecimal() else c for c in text) + "".join(rest)
    if kind == "email":
        return new.upper() if text.isupper() else new
    if kind.startswith("name"):
        return "-".join(p.capitalize() for p in new.split("-")) if not text.isupper() else new.upper()
    return new


def _entities(batches):
    for batch in batches:
        rows, seen = [], set()
        for text in batch.column("text").to_pylist():
            for start, end, kind in find_entities(text or ""):
                form = canonical(kind, text[start:end])
                if (kind, form) not in seen:
                    seen.add((kind, form))
                    rows.append({"kind": kind, "form": form})
        yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("kind", pa.string()), ("form", pa.string())]))


def _drawn(key: bytes):
    def run(batches):
        for batch in batches:
            new = [surrogate(k, f, key, d) for k, f, d in zip(*(batch.column(c).to_pylist() for c in ("kind", "form", "draw")))]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("kind", "form", "draw")), pa.array(new, pa.string())],
                                             names=["kind", "form", "draw", "new"])
    return run


def surrogate_table(docs: DataFrame, key: bytes = KEY) -> DataFrame:
    """``(kind, form, draw, new)`` for the distinct entities of all texts,
    without two equal surrogates of a kind and without surrogates that are
    entities themselves."""
    schema = "kind string, form string, draw int, new string"
    forms = written(docs.select("text").mapInArrow(_entities, "kind string, form string").distinct(), "pii-forms")
    table = written(forms.withColumn("draw", F.lit(0)).mapInArrow(_drawn(key), schema), "pii-draw0")
    real = forms.select("kind", F.col("form").alias("new"), F.lit(True).alias("real"))
    step = 0
    while True:
        step += 1
        first = table.groupBy("kind", "new").agg(F.min(F.struct("draw", "form"))["form"].alias("owner"))
        marked = (table.join(first, ["kind", "new"]).join(real, ["kind", "new"], "left")
                  .withColumn("again", (F.col("owner") != F.col("form")) | F.coalesce("real", F.lit(False))))
        marked = written(marked.select("kind", "form", "draw", "new", "again"), f"pii-check{step}")
        if not marked.filter("again").limit(1).count():
            return marked.drop("again")
        redrawn = (marked.filter("again").select("kind", "form", (F.col("draw") + 1).alias("draw"))
                   .mapInArrow(_drawn(key), schema))
        table = written(marked.filter("not again").drop("again").unionByName(redrawn), f"pii-draw{step}")


def _rewritten(key: bytes, fixed, columns: list[str]):
    """Rewrite texts; ``fixed`` is the broadcast of redrawn surrogates, or
    None where each row brings its own as ``_fixed``."""
    def run(batches):
        common = {(k, f): n for k, f, n in received(fixed)} if fixed is not None else {}
        for batch in batches:
            texts, counts = [], []
            own = batch.column("_fixed").to_pylist() if fixed is None else None
            for i, text in enumerate(batch.column("text").to_pylist()):
                known = common if own is None else {(x["kind"], x["form"]): x["new"] for x in own[i] or []}
                out, last, n = [], 0, 0
                for start, end, kind in find_entities(text or ""):
                    old = text[start:end]
                    form = canonical(kind, old)
                    new = known.get((kind, form)) or surrogate(kind, form, key)
                    out += [text[last:start], dressed(kind, new, old)]
                    last, n = end, n + 1
                texts.append(text if not n else "".join(out) + text[last:])
                counts.append(n)
            arrays = [pa.array(texts, pa.string()) if c == "text" else batch.column(c) for c in columns]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(counts, pa.int32())], names=[*columns, "n_entities"])
        pa.default_memory_pool().release_unused()
    return run


def _row_forms(batches):
    for batch in batches:
        rows = [{"kind": kind, "form": canonical(kind, text[start:end]), "_text": h}
                for text, h in zip(batch.column("text").to_pylist(), batch.column("_text").to_pylist())
                for start, end, kind in find_entities(text or "")]
        yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("kind", pa.string()), ("form", pa.string()), ("_text", pa.int64())]))


def pseudonymise(docs: DataFrame, key: bytes = KEY, broadcast_limit: int = BROADCAST_REDRAWN) -> DataFrame:
    """``docs`` with every entity of ``text`` replaced, and ``n_entities``.

    NULL and empty texts stay as they are.  Repeated rows are rewritten
    alike.  Other columns pass through (a column ``n_entities`` is
    replaced); an empty table gives no rows.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    docs = docs.drop(*[c for c in docs.columns if c.lower() == "n_entities"])
    redrawn = written(surrogate_table(docs, key).filter("draw > 0").select("kind", "form", "new"), "pii-redrawn")
    schema = docs.schema.simpleString()
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields] + ["n_entities int"])
    if redrawn.count() <= broadcast_limit:
        fixed = shared(spark, [tuple(r) for r in redrawn.collect()])
        return docs.mapInArrow(_rewritten(key, fixed, docs.columns), schema)
    rows = docs.withColumn("_text", F.xxhash64("text"))
    own = (rows.select("text", "_text").mapInArrow(_row_forms, "kind string, form string, _text long").distinct()
           .join(redrawn, ["kind", "form"]).groupBy("_text").agg(F.collect_list(F.struct("kind", "form", "new")).alias("_fixed")))
    return rows.join(own, "_text", "left").mapInArrow(_rewritten(key, None, docs.columns), schema)
