"""What the author of a mail wrote: MIME parts decoded; quotes, signatures and boilerplate left out.

Boilerplate is not listed here: it is what many senders write word for word (:func:`marks` and
:func:`tidemark.llm.reading.boilerplate`).
"""

from __future__ import annotations

import binascii
import html
import re
from collections.abc import Container

import xxhash

_HEADER = re.compile(r"[A-Za-z][A-Za-z0-9-]*:")
_CONTROL = re.compile("[\x00-\x08\x0b-\x1f\x7f]")
_FOLD = re.compile(r"\n[ \t]+")
_BOUNDARY = re.compile(r'boundary\s*=\s*(?:"([^"\n]+)"|([^\s;]+))', re.I)
_CHARSET = re.compile(r'charset\s*=\s*"?([\w.:-]+)', re.I)
_NOT64 = re.compile(r"[^A-Za-z0-9+/]")
_HIDDEN = re.compile(r"<(head|style|script|title|blockquote)\b.*?(?:</\1\s*>|\Z)", re.I | re.S)
_BREAK = re.compile(r"<(?:br|/?p|/?div|/?tr|/?li|/?h[1-6]|hr)\b[^>]*>", re.I)
_GAPS = re.compile(r"\n[ \t]*\n\s*")
_TAG = re.compile(r"<[^<>]*>")
_MOJIBAKE = re.compile("[ÃÂâ][\u0080-¿€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ]")
#: Marks with which mail programs quote a line.
_QUOTE = re.compile(r"\s*(?:[>|]|:(?=[\s>|:]|$))")
#: The line that introduces a quote; it can run over two lines.
_SAID = re.compile(r"(?:wrote|writes|escribió|escribio|a écrit|a ecrit|schrieb(?: [^\n:]{1,60})?)\s*:\s*$", re.I)
_SAID_START = re.compile(r"\s*(?:on|am|le|el)\b.*\d", re.I)
#: What follows is someone else's mail.
_ORIGINAL = re.compile(r"\s*(?:-{2,}\s*(?:original message|forwarded message|begin forwarded|urspr\S*ngliche nachricht|weitergeleitete nachricht|mensaje (?:original|reenviado)|message (?:d'origine|transféré|original))|_{8,}\s*$|begin forwarded message)", re.I)
#: A line drawn with marks.
_RULER = re.compile(r"\s*(?:[*=_~-]{8,}|_{3,})\s*$")
_DASHES = re.compile(r"\s*--\s*$")
#: How mails close, as a line of its own; the name and signature follow. Fixed values.
_CLOSING = re.compile(
    r"\s*(?:(?:(?:with|many)\s+)?(?:best|kind|warm|kindest|warmest)?\s*(?:regards|wishes)|(?:many\s+)?thanks(?:\s+(?:again|a lot|in advance))?|thank you(?:\s+(?:again|very much|in advance))?|all the best|cheers|sincerely|yours(?:\s+\w+)?"
    r"|viele grüße|mit freundlichen grüßen|liebe grüße|beste grüße|gruß|grüße|(?:un cordial )?saludos?|un (?:cordial )?saludo|saludos(?:\s+cordiales)?|atentamente|(?:bien )?cordialement|merci|bien à vous|amicalement|sincères salutations)\s*[,.!]?\s*$",
    re.I,
)
#: Lines of a signature: how many at most, how long, and from how many words on a line with a stop is a sentence.
_SIGNATURE, _SHORT, _SENTENCE = 14, 64, 4
#: Headers by which mail programs say that no author wrote a mail. Fixed values of public standards.
_MACHINE = {"auto-submitted": re.compile(r"(?!no\b)"), "precedence": re.compile(r"(?:bulk|junk|auto_reply)\b", re.I), "return-path": re.compile(r"<\s*>"), "x-autoreply": re.compile(""), "x-autorespond": re.compile(""), "content-type": re.compile(r"multipart/report\b", re.I)}
#: Words that a line has at least to be told as boilerplate.
WORDS = 4
_BLANK = re.compile(r"\n[ \t\r]*\n")
_FROM = re.compile(r"^from:(.*)$", re.I | re.M)
_DIGITS = re.compile(r"\d+")
_GREETING = re.compile(r"\s*(?:hi|hello|dear|hey|hallo|liebe[rs]?|guten tag|sehr geehrte\w*|hola|estimad\w+|buenos días|buenas tardes|querid\w+|bonjour|salut|chers?|chère)\b[^.!?\n]{0,40},?\s*$", re.I)


def _headers(text: str) -> tuple[dict[str, str], str]:
    head, gap, body = text.partition("\n\n")
    if head.startswith("From ") and "\n" in head:
        head = head.split("\n", 1)[1]
    if not _HEADER.match(head):
        return {}, text
    out: dict[str, str] = {}
    for line in _FOLD.sub(" ", head).split("\n"):
        name, colon, value = line.partition(":")
        if colon:
            out.setdefault(name.strip().lower(), value.strip())
    return out, body


def _decode(body: str, how: str, charset: str) -> str:
    if how == "base64":
        clean = _NOT64.sub("", body)
        clean = clean[: len(clean) // 4 * 4 + (len(clean) % 4 if len(clean) % 4 > 1 else 0)]
        data = binascii.a2b_base64(clean + "=" * (-len(clean) % 4))
    elif how == "quoted-printable":
        data = binascii.a2b_qp(body.encode("utf-8", "replace"))
    else:
        return body
    try:
        return data.decode("utf-8")
    except UnicodeDecodeError:
        try:
            return data.decode(charset if charset and "utf" not in charset.lower() else "utf-8", "replace" if "utf" in (charset or "utf").lower() else "strict")
        except (LookupError, UnicodeDecodeError):
            return data.decode("cp1252", "replace")


def _html(text: str) -> str:
    return html.unescape(_GAPS.sub("\n\n", _TAG.sub(" ", _BREAK.sub("\n", _HIDDEN.sub("\n", text)))))


def _texts(head: dict[str, str], body: str, depth: int = 0) -> str:
    kind = head.get("content-type", "text/plain")
    low = kind.lower()
    if head.get("content-disposition", "").lower().startswith("attachment"):
        return ""
    if low.startswith("multipart/") and depth < 8 and (m := _BOUNDARY.search(kind)):
        mark = "\n--" + (m[1] or m[2])
        found = []
        for part in ("\n" + body).split(mark)[1:]:
            if part.startswith("--"):
                break
            inner, text = _headers(part.partition("\n")[2] + "\n\n" * ("\n\n" not in part))
            if not inner:
                text = text.lstrip("\n")
            found.append((inner.get("content-type", "text/plain").lower(), _texts(inner, text, depth + 1)))
        if low.startswith("multipart/alternative"):
            plain = [t for k, t in found if t.strip() and not k.startswith("text/html")]
            return plain[0] if plain else next((t for _, t in found if t.strip()), "")
        return "\n\n".join(t for _, t in found if t)
    if not low.startswith("text/") and "/" in low:
        return ""
    charset = m[1] if (m := _CHARSET.search(kind)) else ""
    text = _decode(body, head.get("content-transfer-encoding", "").lower(), charset).replace("\r\n", "\n").replace("\r", "\n")
    return _html(text) if low.startswith("text/html") or text.lstrip()[:6].lower() == "<html>" else text


def repair(text: str) -> str:
    """Text whose UTF-8 was read as a one-byte code, read again; other text as it is."""
    for _ in range(2):
        if not _MOJIBAKE.search(text):
            break
        out = []
        for line in text.split("\n"):
            if _MOJIBAKE.search(line):
                try:
                    line = b"".join(c.encode("cp1252") if c not in "\x81\x8d\x8f\x90\x9d" and not "\x80" <= c <= "\x9f" else c.encode("latin-1") for c in line).decode("utf-8")
                except (UnicodeEncodeError, UnicodeDecodeError):
                    pass
            out.append(line)
        text = "\n".join(out)
    return text


def _colon(line: str) -> bool:
    return line.rstrip()[-1:] == ":"


def _below(lines: list[str], marker: int) -> int:
    """Where the reply starts that stands below an unmarked original: behind a wider gap, else at a
    second greeting, the first marked quote or the first broken sentence, else nowhere."""
    n = len(lines)
    body = next((j for j in range(marker, n) if not lines[j].strip()), n)
    for j in range(body, n - 1):
        if not lines[j].strip() and not lines[j + 1].strip():
            return j
    written = [j for j in range(body, n) if lines[j].strip()]
    greeted = [j for j in written[2:] if _GREETING.match(lines[j])]
    marked = [j for j in written if _QUOTE.match(lines[j]) or _colon(lines[j]) and _SAID.search(lines[j])]
    # a paragraph of the original that breaks off without a stop was cut by the reply
    broken = [j + 1 for j in written if j + 1 < n and not lines[j + 1].strip() and lines[j].rstrip()[-1:] not in ".!?,:;" and lines[j].rstrip()[-1:].isalpha()]
    return min([*greeted[:1], *marked[:1], *broken[:1]], default=n)


def own(raw: str | None) -> list[str]:
    """The lines of a mail that are neither headers, attachments, quotes nor greetings; blank ones for gaps.

    Signature and boilerplate are still among them. Mails that a program marks as its own
    (Auto-Submitted, Precedence, a null Return-Path, multipart/report), null and blank ones have none.
    """
    if not raw or not raw.strip():
        return []
    head, body = _headers(_CONTROL.sub("", raw.replace("\r\n", "\n").replace("\r", "\n")).lstrip("\ufeff\n"))
    if any(k in head and test.match(head[k].strip()) for k, test in _MACHINE.items()):
        return []
    kept: list[str] = []
    lines = repair(_texts(head, body)).split("\n")
    i, n = 0, len(lines)
    while i < n:
        line = lines[i]
        i += 1
        if not line.strip():
            kept.append("")
            continue
        if _QUOTE.match(line):
            continue
        if _colon(line) and _SAID.search(line):
            # an introduction that began on the line before
            if kept and kept[-1] and not _SAID_START.match(line) and _SAID_START.match(kept[-1]):
                kept.pop()
            continue
        if i < n and _colon(lines[i]) and _SAID_START.match(line) and _SAID.search(lines[i]):
            i += 1
            continue
        if _ORIGINAL.match(line) and not (_RULER.match(line) and not _quoted_head(lines, i)):
            if any(kept):
                break
            i = _below(lines, max(j for j in range(i - 1, n) if _ORIGINAL.match(lines[j])))
            continue
        if _GREETING.match(line):
            continue
        kept.append(line.strip())
    return kept


def _quoted_head(lines: list[str], i: int) -> bool:
    """Whether the head of another mail follows a line: a name with a colon right below it."""
    return i < len(lines) and bool(_HEADER.match(lines[i].strip()))


def normal(line: str) -> str:
    """A line as it is compared with others: lower case, single blanks, numbers all alike."""
    return _DIGITS.sub("#", " ".join(line.lower().split()))


def marks(lines: list[str]) -> set[int]:
    """Hashes of the lines of at least WORDS words, as signed 64-bit numbers."""
    return {_mark(x) for x in lines if len(x.split()) >= WORDS}


def sender(raw: str | None) -> int:
    """A number for who a mail says it is from; 0 where it does not say."""
    m = _FROM.search(_BLANK.split(raw.lstrip(), maxsplit=1)[0]) if raw else None
    return xxhash.xxh3_64_intdigest(m[1].strip().lower()) if m else 0


def _mark(line: str) -> int:
    n = xxhash.xxh3_64_intdigest(normal(line))
    return n - (1 << 64) if n >> 63 else n


def prose(lines: list[str], boilerplate: Container[int] = frozenset()) -> str:
    """What is left of :func:`own` lines without paragraphs that have a line of boilerplate, without rulers and the signature.

    A signature begins with a closing, two dashes or a ruler, and has only a few short lines that
    are no sentences up to the end.
    """
    paragraphs: list[list[str]] = [[]]
    for line in lines:
        if not line or _RULER.match(line):
            paragraphs.append([line] if line else [])
            paragraphs.append([])
        else:
            paragraphs[-1].append(line)
    if boilerplate:
        paragraphs = [p for p in paragraphs if not any(len(x.split()) >= WORDS and _mark(x) in boilerplate for x in p)]
    kept: list[str] = []
    for p in paragraphs:
        kept += p or ([""] if kept and kept[-1] else [])
    end, short = len(kept), 0
    for i in range(len(kept) - 1, -1, -1):
        line = kept[i]
        if not line:
            continue
        if _CLOSING.match(line) or _DASHES.match(line) or _RULER.match(line):
            end = i
            continue
        short += 1
        if short > _SIGNATURE or len(line) > _SHORT or (line[-1] in ".!?" and len(line.split()) >= _SENTENCE):
            break
    return "\n".join(x for x in kept[:end] if not _RULER.match(x)).strip()


def author(raw: str | None, boilerplate: Container[int] = frozenset()) -> str:
    """The author's own prose of a raw mail, line by line; empty if there is none.

    Null, empty and blank mails, mails of programs and mails that only quote give the empty text. A
    mail without headers counts as a body. Broken parts give what can be decoded of them.
    ``boilerplate`` are the hashes of lines that many senders write.
    """
    return prose(own(raw), boilerplate)
