"""Masks for free text.

A mask keeps the text around each hit and swaps the hit for ``label<16 hex digits>``, a
keyed hash of the value. Equal values get equal tokens under one seed, whatever the text.
"""

from __future__ import annotations

import functools
import hashlib
import hmac
import itertools
import json
import operator
import os
import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from rowferry.functions.cells import strip
from rowferry.functions.text import ascii_bounds

# Fixed values.
BYPASS_MARKER = "@@NO_ANON@@"
SECRET_KEYS = "accessToken|refreshToken|clientSecret|password|authorization|sessionId|token"
QUERY_MARKS = (
    "query string:",
    "final source query:",
    "final target query:",
    "final delete query:",
    "[diagnostic] delete query:",
    "malformed query string:",
    "malformed delete query string:",
    "failed to parse soql query.",
    "sourcerecordsfilter",
)
RULE_MARKS = ("value mapping rules:", 'value mapping rule "')
SECRET_MARKS = ("token", "clientsecret", "password", "authorization", "sessionid")
DOMAIN_MARKS = (".com", ".net", ".org", ".io", ".dev", ".app", ".cloud", ".local")
RECORD_ID = r"^[A-Za-z0-9]{15}(?:[A-Za-z0-9]{3})?$"

SECRET_DOUBLE_QUOTED = rf'(?i)("?({SECRET_KEYS})"?\s*[:=]\s*")([^"]*)(")'
SECRET_SINGLE_QUOTED = rf"(?i)('(?:{SECRET_KEYS})'\s*:\s*')([^']*)(')"
SECRET_BARE = rf"(?i)(\b({SECRET_KEYS})\b\s*[=:]\s*)([^,\s;]+)"
BEARER = r"(?i)\bBearer\s+([A-Za-z0-9._~+\-/=]+)"
EMAIL = r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b"
URL = r"""(?i)\bhttps?://[^\s'")]+"""
DOMAIN = r"(?i)\b(?:[a-z0-9-]+\.)+(?:com|net|org|io|dev|app|cloud|local)\b"
DRIVE_PATH = r"""\b[A-Za-z]:[\\/][^\s'"]+"""
SHARE_PATH = r"""\\\\[^\s'"]+[\\/][^\s'"]+(?:[\\/][^\s'"]+)*"""
PROMPT = r"(?i)(\bPROMPT ANSWER:\s*)(.*)\z"
IN_LIST = r"(?i)(\bIN\s*\()([^)]*)(\))"
FIELD_COMPARISON = (
    r"(?i)(\b[A-Za-z_][A-Za-z0-9_.]*(?:__c|__r(?:\.[A-Za-z_][A-Za-z0-9_]*)?)\b"
    r"\s*(?:=|!=|<>|LIKE|NOT\s+LIKE)\s*)"
    r"""('(?:[^'\\]++|\\.|\\)*'|"(?:[^"\\]++|\\.|\\)*")"""
)
# Runs between backslashes are taken whole. One step per character would use up the stack.
QUOTED_SINGLE = r"'((?:[^'\\]++|\\.|\\)*)'"
QUOTED_DOUBLE = r'"((?:[^"\\]++|\\.|\\)*)"'
VALUE_PAIR = r"(\]\s\{[^}]+\}\s+-\s*[^:]+:\s*)(.+?)(\.)?\z"
SELECT_FROM = r"(?i)\bselect\b[\s\S]*\bfrom\b"
STACK_LINE = r"\n\s*at\s+"
STACK_CALL = r"\sat\s+[^(]+\([^)]+\)"


def _pads(seed: str) -> tuple[bytes, bytes]:
    key = seed.encode()
    if len(key) > 64:
        key = hashlib.sha256(key).digest()
    key = key.ljust(64, b"\0")
    return bytes(b ^ 0x36 for b in key), bytes(b ^ 0x5C for b in key)


def keyed_hash(value: Column, seed: str) -> Column:
    """First 16 hex digits of HMAC-SHA256, built from two ``sha2`` calls."""
    inner, outer = _pads(seed)
    digest = F.sha2(F.concat(F.lit(inner), F.encode(value, "UTF-8")), 256)
    return F.upper(F.substring(F.sha2(F.concat(F.lit(outer), F.unhex(digest)), 256), 1, 16))


def keyed_hash_text(value: str, seed: str) -> str:
    """The same hash for a value known on the driver."""
    return hmac.new(seed.encode(), value.encode(), hashlib.sha256).hexdigest().upper()[:16]


def token(label: Column | str, value: Column, seed: str) -> Column:
    name = F.lit(label) if isinstance(label, str) else label
    return F.concat(name, F.lit("<"), keyed_hash(value, seed), F.lit(">"))


def token_unless_id(label: str, value: Column, seed: str) -> Column:
    """15 and 18 character record ids stay, they are no personal data."""
    trimmed = strip(value)
    return F.when(trimmed.rlike(RECORD_ID), trimmed).otherwise(token(label, trimmed, seed))


def holds_any(text: Column, marks: Sequence[str]) -> Column:
    return functools.reduce(operator.or_, [text.contains(mark) for mark in marks])


def replace_hits(text: Column, pattern: str, swap: Callable[[Column], Column], likely: Column | None = None) -> Column:
    """The text with ``swap(hit)`` in place of every hit of ``pattern``.

    ``likely`` is a cheap test that every text with a hit passes; it spares the others the pattern.
    """
    pattern = ascii_bounds(pattern)
    pieces = F.split(text, pattern, -1)
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    merged = F.zip_with(
        pieces, hits, lambda piece, hit: F.concat(piece, F.coalesce(swap(hit), F.lit("")))
    )
    found = text.rlike(pattern) if likely is None else likely & text.rlike(pattern)
    return F.when(found, F.array_join(merged, "")).otherwise(text)


def _group(hit: Column, pattern: str, number: int) -> Column:
    return F.regexp_extract(hit, ascii_bounds(pattern), number)


def holds_known(values: Sequence[str]) -> str:
    """A pattern that finds whether any of the values stands in a text, as one tree of shared beginnings.

    A value that begins with another one adds nothing, so the tree only branches where values differ.
    """
    kept: list[str] = []
    for value in sorted(set(values)):
        if not (kept and value.startswith(kept[-1])):
            kept.append(value)

    def tree(words: list[str]) -> str:
        head = os.path.commonprefix([words[0], words[-1]])
        branches = [[w[len(head):] for w in group] for _, group in itertools.groupby(words, lambda w: w[len(head): len(head) + 1])]
        if len(words) == 1:
            return re.escape(head)
        return re.escape(head) + "(?:" + "|".join(tree(branch) for branch in branches) + ")"

    return tree(kept)


def mask_known(text: Column, entries: Sequence[tuple[str, str]], seed: str) -> Column:
    """Literal ``(value, label)`` pairs, longest value first. Record ids stay.

    The entries are one constant array that is walked inside a task, so the expression is as deep for
    thousands of them as for one. Texts that hold none, mostly, cost one search of a pattern.
    """
    unique = list(dict.fromkeys((value.strip(), label.strip()) for value, label in entries))
    swaps = [
        (value, f"{label}<{keyed_hash_text(value, seed)}>")
        for value, label in sorted(unique, key=lambda entry: -len(entry[0]))
        if value and label and not (value.isascii() and value.isalnum() and len(value) in (15, 18))
    ]
    if not swaps:
        return text
    table = F.from_json(F.lit(json.dumps([{"v": v, "t": t} for v, t in swaps])), "array<struct<v:string,t:string>>")
    masked = F.aggregate(table, text, lambda out, swap: F.replace(out, swap["v"], swap["t"]))
    return F.when(text.rlike(holds_known([v for v, _ in swaps])), masked).otherwise(text)


def mask_double_quoted_secrets(text: Column, seed: str, likely: Column | None = None) -> Column:
    p = SECRET_DOUBLE_QUOTED

    def swap(hit: Column) -> Column:
        return F.concat(_group(hit, p, 1), token(_group(hit, p, 2), _group(hit, p, 3), seed), F.lit('"'))

    return replace_hits(text, p, swap, likely)


def mask_single_quoted_secrets(text: Column, seed: str, likely: Column | None = None) -> Column:
    p = SECRET_SINGLE_QUOTED

    def swap(hit: Column) -> Column:
        return F.concat(_group(hit, p, 1), token("secret", _group(hit, p, 2), seed), F.lit("'"))

    return replace_hits(text, p, swap, likely)


def mask_bare_secrets(text: Column, seed: str, likely: Column | None = None) -> Column:
    p = SECRET_BARE

    def swap(hit: Column) -> Column:
        return F.concat(_group(hit, p, 1), token(_group(hit, p, 2), _group(hit, p, 3), seed))

    return replace_hits(text, p, swap, likely)


def mask_bearer(text: Column, seed: str, likely: Column | None = None) -> Column:
    def swap(hit: Column) -> Column:
        return F.concat(F.lit("Bearer "), token("bearer", _group(hit, BEARER, 1), seed))

    return replace_hits(text, BEARER, swap, likely)


def mask_emails(text: Column, seed: str, likely: Column | None = None) -> Column:
    return replace_hits(text, EMAIL, lambda hit: token("email", hit, seed), likely)


def mask_urls(text: Column, seed: str, likely: Column | None = None) -> Column:
    return replace_hits(text, URL, lambda hit: token("url", hit, seed), likely)


def mask_domains(text: Column, seed: str, likely: Column | None = None) -> Column:
    return replace_hits(text, DOMAIN, lambda hit: token("domain", hit, seed), likely)


def mask_drive_paths(text: Column, seed: str, likely: Column | None = None) -> Column:
    return replace_hits(text, DRIVE_PATH, lambda hit: token("path", hit, seed), likely)


def mask_share_paths(text: Column, seed: str, likely: Column | None = None) -> Column:
    return replace_hits(text, SHARE_PATH, lambda hit: token("path", hit, seed), likely)


def mask_prompt_answers(text: Column, seed: str, likely: Column | None = None) -> Column:
    """What a person typed at a prompt."""

    def swap(hit: Column) -> Column:
        answer = _group(hit, PROMPT, 2)
        masked = F.concat(_group(hit, PROMPT, 1), token_unless_id("prompt", answer, seed))
        return F.when(strip(answer) == "", hit).otherwise(masked)

    return replace_hits(text, PROMPT, swap, likely)


def mask_value_pairs(text: Column, seed: str, likely: Column | None = None) -> Column:
    """The value of a ``] {object} - name: value.`` line."""

    def swap(hit: Column) -> Column:
        value = token_unless_id("value", _group(hit, VALUE_PAIR, 2), seed)
        return F.concat(_group(hit, VALUE_PAIR, 1), value, _group(hit, VALUE_PAIR, 3))

    return replace_hits(text, VALUE_PAIR, swap, likely)


def _mask_quoted(text: Column, pattern: str, quote: str, seed: str) -> Column:
    return replace_hits(
        text,
        pattern,
        lambda hit: F.concat(
            F.lit(quote), token_unless_id("soql", _group(hit, pattern, 1), seed), F.lit(quote)
        ),
    )


def holds_query(text: Column, lower: Column | None = None) -> Column:
    """Lines whose literals are masked."""
    lower = F.lower(text) if lower is None else lower
    selects = lower.contains("select") & lower.contains("from") & text.rlike(ascii_bounds(SELECT_FROM))
    return holds_any(lower, QUERY_MARKS) | selects


def _mask_list_quotes(text: Column, pattern: str, quote: str, seed: str, likely: Column | None) -> Column:
    def swap(hit: Column) -> Column:
        body = _mask_quoted(_group(hit, IN_LIST, 2), pattern, quote, seed)
        return F.concat(_group(hit, IN_LIST, 1), body, F.lit(")"))

    return replace_hits(text, IN_LIST, swap, holds_query(text) if likely is None else likely)


def mask_in_lists_single(text: Column, seed: str, likely: Column | None = None) -> Column:
    return _mask_list_quotes(text, QUOTED_SINGLE, "'", seed, likely)


def mask_in_lists_double(text: Column, seed: str, likely: Column | None = None) -> Column:
    return _mask_list_quotes(text, QUOTED_DOUBLE, '"', seed, likely)


def mask_comparisons(text: Column, seed: str, likely: Column | None = None) -> Column:
    """Literals compared with custom fields."""
    p = FIELD_COMPARISON

    def swap(hit: Column) -> Column:
        literal = _group(hit, p, 2)
        quote = F.substring(literal, 1, 1)
        value = F.substring(literal, F.lit(2), F.length(literal) - 2)
        return F.concat(_group(hit, p, 1), quote, token_unless_id("soql", value, seed), quote)

    return replace_hits(text, p, swap, holds_query(text) if likely is None else likely)


def bypasses(text: Column) -> Column:
    """Marked lines, stack traces and value-rule lines stay as they are."""
    lower = F.lower(text)
    bypass = text.contains(BYPASS_MARKER) | text.contains("[STACK TRACE]")
    for mark in RULE_MARKS:
        bypass = bypass | lower.contains(mark)
    calls = text.contains("(") & text.contains(")") & text.rlike(STACK_CALL)
    return bypass | text.rlike(STACK_LINE) | calls


def without_marker(text: Column) -> Column:
    return F.replace(text, F.lit(BYPASS_MARKER), F.lit(""))


def signs(text: Column, lower: Column) -> dict[str, Column]:
    """Plain searches that tell which masks a text can need, by name."""
    return {
        "secret": holds_any(lower, SECRET_MARKS),
        "bearer": lower.contains("bearer"),
        "email": text.contains("@"),
        "url": text.contains("://"),
        "domain": holds_any(lower, DOMAIN_MARKS),
        "drive": holds_any(text, (":\\", ":/")),
        "share": text.contains("\\\\"),
        "query": holds_query(text, lower),
        "pair": text.contains("]") & text.contains("{"),
    }


#: The order in which the masks run, each with the sign it needs.
STAGES: tuple[tuple[Callable[..., Column], str], ...] = (
    (mask_double_quoted_secrets, "secret"),
    (mask_single_quoted_secrets, "secret"),
    (mask_bare_secrets, "secret"),
    (mask_bearer, "bearer"),
    (mask_emails, "email"),
    (mask_urls, "url"),
    (mask_domains, "domain"),
    (mask_drive_paths, "drive"),
    (mask_share_paths, "share"),
    (mask_in_lists_single, "query"),
    (mask_in_lists_double, "query"),
    (mask_comparisons, "query"),
    (mask_value_pairs, "pair"),
)
