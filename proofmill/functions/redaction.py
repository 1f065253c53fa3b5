"""Secret masking as column expressions."""

from __future__ import annotations

import json
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from proofmill.functions.canonical import let

# Member names and endings that mark a secret, value patterns, placeholders.
SECRET_KEY_NAMES = [
    "token", "access_token", "refresh_token", "id_token",
    "auth", "authorization", "auth_header",
    "secret", "client_secret", "api_secret", "private_key",
    "password", "passwd",
    "api_key", "apikey", "credential", "credentials",
]
SECRET_KEY_SUFFIXES = ["_api_key", "_secret", "_password", "_token"]
API_KEY_PATTERN = r"sk-[A-Za-z0-9][A-Za-z0-9._-]{6,}"
SIGNED_TOKEN_PATTERN = r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"
SECRET_CONFIG_KEYS = ["api_key", "token", "secret", "password"]
SECRET_PLACEHOLDERS = ["EMPTY", "***", "REDACTED"]

# A scheme run is entered only at its first character, so long unbroken text
# costs one pass; the credentials end at the first '@' before '/' or blank.
URL_CREDENTIALS_PATTERN = r"(?U)(?<![a-zA-Z0-9+.-])([0-9+.-]*[a-zA-Z][a-zA-Z0-9+.-]*+://)[^/@\s]+@"

MASK = "***"

_TOKEN = re.compile(r'"(?:[^"\\]|\\.)*"|[{}\[\],:]|[^"{}\[\],:\s]+')
_URL, _KEY, _SIGNED = (re.compile(p.replace("(?U)", "")) for p in (URL_CREDENTIALS_PATTERN, API_KEY_PATTERN, SIGNED_TOKEN_PATTERN))


def _secret_name(name: str) -> bool:
    plain = name.strip().lower().replace("-", "_").replace(" ", "_")
    return plain in SECRET_KEY_NAMES or plain.endswith(tuple(SECRET_KEY_SUFFIXES))


def _masked(text: str) -> str:
    return _SIGNED.sub(MASK, _KEY.sub(MASK, _URL.sub(r"\1***@", text)))


def mask_json(text: str) -> str:
    """A JSON text with the values of secret members masked and its other strings redacted: one pass over its tokens, at
    any depth. Everything else is kept as it is written."""
    out: list[str] = []
    inside: list[str] = []  # open brackets
    name_next = hide = False
    hidden_from: int | None = None  # depth of the container that is being left out
    for token in _TOKEN.findall(text):
        if hidden_from is not None:
            inside.append(token) if token in "{[" else inside.pop() if token in "}]" else None
            if len(inside) == hidden_from:
                hidden_from = None
        elif token in "{[":
            if hide:
                hidden_from, hide = len(inside), False
                out.append(f'"{MASK}"')
            else:
                out.append(token)
            inside.append(token)
            name_next = token == "{"
        elif token in "}]":
            inside.pop()
            out.append(token)
            name_next = False
        elif token in ",:":
            out.append(token)
            name_next = token == "," and inside[-1] == "{"
        elif name_next:
            hide, name_next = _secret_name(json.loads(token)), False
            out.append(token)
        elif hide:
            out.append(f'"{MASK}"')
            hide = False
        else:
            out.append(json.dumps(_masked(json.loads(token)), ensure_ascii=False) if token[0] == '"' else token)
    return "".join(out)


def mask_url_credentials(text: Column) -> Column:
    return F.when(
        text.contains("://") & text.contains("@"), F.regexp_replace(text, URL_CREDENTIALS_PATTERN, "$1***@")
    ).otherwise(text)


def mask_known(text: Column, secrets: Column) -> Column:
    """Replace each known secret literally, in list order."""
    return F.aggregate(
        F.filter(F.coalesce(secrets, F.array().cast("array<string>")), lambda s: s.isNotNull() & (s != "")),
        text,
        lambda acc, secret: F.replace(acc, secret, F.lit(MASK)),
    )


def mask_patterns(text: Column) -> Column:
    keys = F.when(text.contains("sk-"), F.regexp_replace(text, API_KEY_PATTERN, MASK)).otherwise(text)
    return let(
        keys, lambda t: F.when(t.contains("eyJ"), F.regexp_replace(t, SIGNED_TOKEN_PATTERN, MASK)).otherwise(t)
    )


def redact_text(text: Column, secrets: Column | None = None) -> Column:
    """Mask URL credentials, then known secrets, then values that look like keys."""
    masked = let(F.coalesce(text, F.lit("")), mask_url_credentials)
    if secrets is not None:
        masked = mask_known(masked, secrets)
    return let(masked, mask_patterns)


def is_secret_key(name: Column) -> Column:
    plain = F.regexp_replace(F.lower(F.regexp_replace(name, r"^(?U)\s+|\s+$", "")), "[- ]", "_")
    by_suffix = F.lit(False)
    for suffix in SECRET_KEY_SUFFIXES:
        by_suffix = by_suffix | plain.endswith(suffix)
    return plain.isin(SECRET_KEY_NAMES) | by_suffix


def is_real_secret(value: Column) -> Column:
    return (
        value.isNotNull()
        & ~value.isin(SECRET_PLACEHOLDERS)
        & (F.regexp_replace(value, r"^\*+|\*+$", "") != "")
    )
