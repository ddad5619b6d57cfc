"""Operator 4: personal data by patterns, checksums and context words.

Patterns propose spans, validators confirm them (octet range for addresses,
Luhn for cards, digit counts for phones, mod-97 for bank accounts), and words
near a span raise or lower its score.  Every pattern is anchored so that a
text is scanned in time linear in its length, whatever it holds.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import col, map_texts

# Kinds in the order of the result, and their patterns.
KINDS = ("email", "ip", "card", "phone", "iban")
BASE_KINDS = KINDS[:4]
_domain = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_ip = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_card = re.compile(r"[0-9](?:[ -]?[0-9])+")
_phone = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_iban = re.compile(r"(?<![A-Za-z0-9])(?=([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}))")
_ends = re.compile(r"(?<=[A-Z0-9])(?![A-Za-z0-9])")
# Words that make a kind more, or any kind less, likely nearby.
CONTEXT = {
    "email": ("email", "e-mail", "mail", "contact", "write"),
    "ip": ("ip", "address", "host", "server", "login"),
    "card": ("card", "visa", "credit", "debit", "payment"),
    "phone": ("phone", "tel", "call", "mobile", "fax"),
    "iban": ("iban", "account", "bank", "transfer", "swift"),
}
AGAINST = ("example", "sample", "test", "dummy", "version")
# Score of a confirmed span before context; step of a context word.
PRIOR = {"email": 0.9, "ip": 0.7, "card": 0.8, "phone": 0.7, "iban": 0.8}
STEP = 0.1
#: characters on each side in which context words count
WINDOW = 40
_near = {k: re.compile(r"\b(?:" + "|".join(map(re.escape, w)) + r")\b", re.I) for k, w in CONTEXT.items()}
_against = re.compile(r"\b(?:" + "|".join(AGAINST) + r")\b", re.I)
_digits = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d)
        total += n if k % 2 == 0 else n * 2 - 9 * (n > 4)
    return total % 10 == 0


def mod97(account: str) -> bool:
    plain = account.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def _emails(text: str):
    """Leftmost matches: the run before an @ that no earlier match has taken, and the domain after it."""
    done = 0
    for m in _domain.finditer(text):
        # a local part holds no @, so these runs never overlap
        run = text[max(done, text.rfind("@", 0, m.start()) + 1) : m.start()]
        local = _tail(run)
        if local:
            yield m.start() - local, m.end()
            done = m.end()


def _tail(run: str) -> int:
    """Length of the local-part characters that end ``run``."""
    n = len(run)
    while n and (run[n - 1].isascii() and (run[n - 1].isalnum() or run[n - 1] in "._%+-")):
        n -= 1
    return len(run) - n


def _ibans(text: str):
    """Accounts: of the ends of words after a start, the last one up to which mod-97 holds."""
    done = 0
    for m in _iban.finditer(text):
        a, b = m.span(1)
        if a < done:
            continue
        for end in reversed([e.start() for e in _ends.finditer(text, a, min(b + 1, len(text))) if e.start() <= b]):
            # 4 and at least 11 characters
            if end - a - text.count(" ", a, end) >= 15 and mod97(text[a:end]):
                yield a, end
                done = end
                break


def _octet(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and (not part or int(part) < 256)


def spans(text: str | None) -> list[tuple[str, int, int]]:
    """Confirmed (kind, start, end) of a text, by kind as listed, then start."""
    if not text:
        return []
    out = [("email", a, b) for a, b in _emails(text)] if "@" in text else []
    if _digits.search(text):
        out += [("ip", *m.span()) for m in _ip.finditer(text) if all(map(_octet, m.group().split(".")))]
        for m in _card.finditer(text):
            if m.end() - m.start() >= 16:
                number = m.group().replace(" ", "").replace("-", "")
                if 16 <= len(number) <= 19 and luhn(number):
                    out.append(("card", *m.span()))
        if "+" in text:
            out += [("phone", *m.span()) for m in _phone.finditer(text) if 8 <= len(_digits.findall(m.group())) <= 15]
        out += [("iban", a, b) for a, b in _ibans(text)]
    return out


def score(text: str, kind: str, start: int, end: int) -> float:
    """How sure a confirmed span is: a prior by kind, moved by words near it."""
    near = text[max(0, start - WINDOW) : start] + " " + text[end : end + WINDOW]
    value = PRIOR[kind] + STEP * len(set(w.lower() for w in _near[kind].findall(near)))
    return round(min(1.0, max(0.0, value - STEP * bool(_against.search(near)))), 3)


def joined(found: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in found)


def redacted(text: str, found: list[tuple[str, int, int]]) -> str:
    """The text with every span replaced by its kind; overlapping spans become one."""
    out, done = [], 0
    for a, b, kind in sorted((a, -b, k) for k, a, b in found):
        b = -b
        if a >= done:
            out += [text[done:a], f"[{kind.upper()}]"]
        done = max(done, b)
    return "".join([*out, text[done:]])


def detect(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = 0.5) -> DataFrame:
    """Personal data of every document.

    Returns the id, ``n_email``, ``n_ip``, ``n_card``, ``n_phone`` (confirmed base
    spans), ``base_sha256`` and ``spans`` (``kind:start:end`` in code points, end
    exclusive), ``n_added`` (spans of the added kinds), ``least_score`` and
    ``n_sure`` (spans scored ``least`` or more).  A null or empty text has no
    spans and a null ``least_score``; rows are independent, so repeated rows,
    ties and extra columns change nothing.
    """

    def make():
        def work(texts):
            rows = []
            for text in texts:
                found = spans(text)
                base = [s for s in found if s[0] in BASE_KINDS]
                kinds = [s[0] for s in found]
                scores = [score(text, *s) for s in found]
                rows.append(
                    [
                        *[kinds.count(k) for k in BASE_KINDS],
                        hashlib.sha256(joined(base).encode()).hexdigest(),
                        joined(found),
                        len(found) - len(base),
                        min(scores, default=None),
                        sum(x >= least for x in scores),
                    ]
                )
            return None, [list(c) for c in zip(*rows)]

        return work

    schema = (
        ", ".join(f"n_{k} long" for k in BASE_KINDS)
        + ", base_sha256 string, spans string, n_added long, least_score double, n_sure long"
    )
    return map_texts(df, text_col, make, schema, (id_col,))


def redact(df: DataFrame, text_col: str = "text", n_chars_col: str | None = None, least: float = 0.5) -> DataFrame:
    """The same table with spans scored ``least`` or more masked in its text; a null text stays null."""
    columns = df.columns
    others = tuple(c for c in columns if c != text_col)

    def make():
        def work(texts):
            out = []
            for text in texts:
                found = [s for s in spans(text) if score(text, *s) >= least]
                out.append(redacted(text, found) if found else text)
            return None, [out]

        return work

    made = map_texts(df, text_col, make, "__llm_masked string", others)
    fields = [col("__llm_masked").alias(text_col) if c == text_col else col(c) for c in columns]
    if n_chars_col in columns:
        fields[columns.index(n_chars_col)] = F.length(col("__llm_masked")).cast(df.schema[n_chars_col].dataType).alias(n_chars_col)
    return made.select(*fields)
