"""Small helper that takes a raw mail apart: headers, text parts, and whether each is complete."""

from __future__ import annotations

import base64
import html
import quopri
import re

_TYPE = re.compile(r"^content-type:[ \t]*([^;\s]*)", re.I | re.M)
_ENCODING = re.compile(r"^content-transfer-encoding:[ \t]*(\S+)", re.I | re.M)
_BOUNDARY = re.compile(r'boundary="?([^"\n;]+)', re.I)
_FROM = re.compile(r"^from:[ \t]*([^<\n]*)", re.I | re.M)
_GONE = re.compile(r"(?is)<(script|style|head)\b.*?</\1\s*>|<!--.*?-->")
_INLINE = re.compile(r"(?i)</?(?:b|i|u|em|strong|span|font|a|small|big|tt|code|s|sub|sup)\b[^>]*>")
_TAG = re.compile(r"<[^>]*>?")
_QUOTE = re.compile(r"(?m)^[>|:][>|: ]*")
_INVISIBLE = dict.fromkeys(map(ord, "­​‌‍⁠﻿"))
_WORD = re.compile(r"[^\W_]+")


def _decode(body: str, encoding: str) -> tuple[str, bool]:
    """The body's text, and whether its encoding is complete."""
    if encoding == "base64":
        data = re.sub(r"[^A-Za-z0-9+/]", "", body)
        whole = len(data) % 4 == 0 or body.rstrip().endswith("=") and len(re.sub(r"[^A-Za-z0-9+/=]", "", body)) % 4 == 0
        data = data[: len(data) - (len(data) % 4 == 1)]
        try:
            raw = base64.b64decode(data + "=" * (-len(data) % 4))
        except ValueError:
            return "", False
        return raw.decode("utf-8", "replace"), whole
    if encoding == "quoted-printable":
        cut = re.search(r"=[0-9A-Fa-f]?$", body) is not None
        return quopri.decodestring(body.encode("utf-8")).decode("utf-8", "replace"), not cut
    return body, True


def take_apart(text: str) -> dict:
    """``sender``, ``missing`` (what is incomplete, or None) and ``parts``: (type, text) of the text parts.

    ``missing`` is headers (no blank line ends them), multipart (no closing
    boundary), html (no closing tag) or encoding (a cut base64 or
    quoted-printable block).
    """
    head, found, body = text.partition("\n\n")
    who = _FROM.search(head)
    out = {"sender": who[1].strip().strip('"') if who else "", "missing": None if found else "headers", "parts": []}
    if not found:
        return out
    kind = (m[1].lower() if (m := _TYPE.search(head)) else "") or "text/plain"
    if kind.startswith("multipart") and (m := _BOUNDARY.search(head)):
        mark = "--" + m[1]
        pieces = re.split(rf"(?m)^{re.escape(mark)}(?:--)?[ \t]*(?:\n|\Z)", body)
        if not re.search(rf"(?m)^{re.escape(mark)}--", body):
            out["missing"] = "multipart"
        sections = [p.partition("\n\n") for p in pieces[1:] if p.strip()]
    else:
        sections = [(head, found, body)]
    for h, _, b in sections:
        kind = (m[1].lower() if (m := _TYPE.search(h)) else "") or "text/plain"
        if not kind.startswith("text/"):
            continue
        plain, whole = _decode(b, (m[1].lower() if (m := _ENCODING.search(h)) else ""))
        if out["missing"] is None and not whole:
            out["missing"] = "encoding"
        if out["missing"] is None and kind == "text/html" and not re.search(r"(?i)</html\s*>\s*\Z", plain):
            out["missing"] = "html"
        out["parts"].append((kind, plain))
    return out


def readable(kind: str, text: str) -> str:
    """A part's text without markup, quote marks and invisible characters."""
    if kind == "text/html":
        text = html.unescape(_TAG.sub(" ", _INLINE.sub("", _GONE.sub(" ", text))))
    return _QUOTE.sub("", text).translate(_INVISIBLE)


def words(text: str) -> list[str]:
    """Runs of letters and digits, without regard to case."""
    return _WORD.findall(text.casefold())
