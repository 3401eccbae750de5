"""Dates, languages, addresses, names, identifiers and predicates of the staged layer, as native expressions."""

from __future__ import annotations

import uuid
from datetime import UTC, datetime
from email.utils import parsedate_to_datetime
from functools import reduce
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lavra.functions.text import let, strip

# Language labels with their codes, and the placeholder of the export.
LANGUAGE_LABELS = {
    "pt": ("por", "pt", "pt-br", "portuguese", "português", "portugues"),
    "en": ("eng", "en", "english", "inglês", "ingles"),
    "es": ("spa", "es", "spanish", "español", "espanhol"),
    "fr": ("fra", "fre", "fr", "french", "francês", "frances"),
    "de": ("deu", "ger", "de", "german", "alemão", "alemao"),
    "it": ("ita", "it", "italian", "italiano"),
}
NOT_INFORMED = "nao informado pela instituicao"
RESTRICTED = "restricted|embargo|private|closed|access denied"
# First bytes of file kinds.
MAGIC = (("255044462D", "application/pdf"), ("89504E470D0A1A0A", "image/png"), ("FFD8FF", "image/jpeg"), ("504B0304", "application/zip"), ("25215053", "application/postscript"))
# Letters with accents of the languages at hand and the letters they stand on.
_ACCENTED, _BASE = "áàâãäåéèêëíìîïóòôõöúùûüçñýÿ", "aaaaaaeeeeiiiiooooouuuucnyy"
UNACCENTED = str.maketrans(_ACCENTED, _BASE)


def nonblank(text: Column) -> Column:
    """Trimmed; null if nothing is left."""
    return F.nullif(strip(text), F.lit(""))


def first_text(*values: Column) -> Column:
    """The first value that is not blank, trimmed; '' if none is."""
    return F.coalesce(*[nonblank(v) for v in values], F.lit(""))


def first_of(values: Column) -> Column:
    """The first element that is not blank, trimmed, or null."""
    return F.get(F.filter(F.transform(values, strip), lambda x: x != ""), F.lit(0))


def texts_of(*arrays: Column) -> Column:
    """All elements of the arrays in order, trimmed, without blanks and nulls."""
    whole = F.concat(*[F.coalesce(a, F.array().cast("array<string>")) for a in arrays])
    return F.filter(F.transform(whole, strip), lambda x: x.isNotNull() & (x != ""))


def year(text: Column) -> Column:
    """The first four digits; '' if there are none."""
    return F.regexp_extract(F.coalesce(text, F.lit("")), r"([0-9]{4})", 1)


def iso_date(text: Column) -> Column:
    """ISO date of the known forms (year, year-month, year-month-day, dd/mm/yyyy, yyyy/mm/dd), else ''; days are not checked."""
    t = strip(F.coalesce(text, F.lit("")))
    return (
        F.when(t.rlike(r"^[0-9]{4}(-[0-9]{2})?(-[0-9]{2})?$"), t)
        .when(t.rlike(r"^[0-9]{2}/[0-9]{2}/[0-9]{4}$"), F.regexp_replace(t, r"^(..)/(..)/(....)$", "$3-$2-$1"))
        .when(t.rlike(r"^[0-9]{4}/[0-9]{2}/[0-9]{2}$"), F.replace(t, F.lit("/"), F.lit("-")))
        .otherwise("")
    )


def language_code(label: Column) -> Column:
    """Two-letter code of a label, '' if it is not known."""
    pairs = [F.lit(x) for code, labels in LANGUAGE_LABELS.items() for label_ in labels for x in (label_, code)]
    return F.coalesce(F.create_map(*pairs)[F.lower(strip(label))], F.lit(""))


def plain(text: Column) -> Column:
    """Lower case without the accents of the languages at hand and without runs of blanks, in generated code."""
    return strip(F.regexp_replace(F.regexp_replace(F.translate(F.lower(text), _ACCENTED, _BASE), r"\p{M}+", ""), r"\s+", " "))


def informed(text: Column) -> Column:
    """Trimmed; '' for null and for the placeholder in any case and with or without accents."""
    t = strip(F.coalesce(text, F.lit("")))
    return F.when(plain(t) == NOT_INFORMED, "").otherwise(t)


def split_values(text: Column) -> Column:
    return F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), r"\|\|"), informed), lambda x: x != "")


def canonical_url(url: Column) -> Column:
    """Scheme and host in lower case, no user, no fragment, '/' for no path; what is no web address is only trimmed."""
    t = strip(url)
    part = lambda i: F.regexp_extract(t, r"^(?i)(https?)://(?:[^/?#]*@)?([^/?#@]+)([^?#]*)(\?[^#]*)?", i)
    path = F.when(part(3) == "", "/").otherwise(part(3))
    return F.when(part(2) == "", t).otherwise(F.concat(F.lower(part(1)), F.lit("://"), F.lower(part(2)), path, F.regexp_replace(part(4), r"^\?$", "")))


def urls_in(text: Column) -> Column:
    """Web addresses in order, without closing punctuation, each once by its canonical form."""
    found = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"((?i:https?)://[^\s|<>\"']+)"))
    trimmed = F.filter(F.transform(found, lambda u: F.regexp_replace(u, r"[.,;:)\]}]+$", "")), lambda u: u.rlike(r"^(?i:https?)://[^/?#]+"))
    once = lambda keys: F.filter(trimmed, lambda u, i: F.array_position(keys, F.get(keys, i)) == i + 1)
    return let(F.transform(trimmed, canonical_url), once)


def safe_name(text: Column, default: str = "item") -> Column:
    named = F.regexp_replace(F.regexp_replace(F.coalesce(text, F.lit("")), r"[^A-Za-z0-9._-]+", "_"), r"^[._]+|[._]+$", "")
    return F.when(named == "", default).otherwise(named)


def record_url(base: str, key: Column) -> Column:
    return F.concat(F.lit(base.rstrip("/") + "/"), F.replace(F.url_encode(key), F.lit("+"), F.lit("%20")))


def plausible_author(name: Column) -> Column:
    t = strip(name)
    dated = t.rlike(r"^([0-9]{4}(-[0-9]{2}(-[0-9]{2})?)?|[0-9]{2}/[0-9]{2}/[0-9]{4}|[0-9]{4}/[0-9]{2}/[0-9]{2})$")
    return F.coalesce((F.length(t) >= 3) & ~dated & t.rlike("[A-Za-zÀ-ÖØ-öø-ÿ]"), F.lit(False))


def author_names(*roles: Column) -> Column:
    """Plausible names of the roles in order, each once."""
    return F.array_distinct(F.filter(texts_of(*roles), plausible_author))


def restricted(rights: Column) -> Column:
    return F.lower(F.coalesce(rights, F.lit(""))).rlike(RESTRICTED)


def open_access(labels: Column) -> Column:
    """One label is exactly ``openaccess`` and none speaks of restriction or embargo."""
    low = F.transform(labels, plain)
    return F.array_contains(low, "openaccess") & ~F.exists(low, lambda x: x.rlike("restrictedaccess|embargoedaccess"))


def metadata_key(title: Column, author: Column, date: Column) -> Column:
    """Folded title, first author and year; '' if all are missing."""
    return F.regexp_replace(F.concat_ws("|", plain(F.coalesce(title, F.lit(""))), plain(F.coalesce(author, F.lit(""))), year(date)), r"\|+$", "")


def surrogate_id(prefix: str, *parts: Column) -> Column:
    """A stable identifier of the parts, which are joined by a separator that no part holds."""
    return F.concat(F.lit(prefix), F.sha2(F.concat_ws("\u001f", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]), 256))


def content_kind(start: Column) -> Column:
    """Kind of a file by its first bytes."""
    head, out = F.hex(start), None
    for prefix, kind in MAGIC:
        out = F.when(head.startswith(prefix), kind) if out is None else out.when(head.startswith(prefix), kind)
    return out.otherwise("application/octet-stream")


def valid_pdf(content_type: Column, payload: Column) -> Column:
    kind = F.lower(strip(F.split_part(F.coalesce(content_type, F.lit("")), F.lit(";"), F.lit(1))))
    tail = F.hex(F.substring(payload, -1024, 1024))
    return (kind == "application/pdf") & F.hex(payload).startswith("255044462D") & tail.contains("2525454F46")


def disposition_name(header: Column) -> Column:
    """File name of a Content-Disposition header, encoded forms decoded; null if there is none."""
    encoded = F.regexp_extract(header, r"(?i)filename\*\s*=\s*[^']*'[^']*'([^;]+)", 1)
    named = F.regexp_extract(header, r"(?i)filename\s*=\s*\"?([^\";]+)\"?", 1)
    return nonblank(F.when(encoded != "", F.try_url_decode(encoded)).otherwise(named))


def retry_after(header: str | None, now: datetime | None = None, most: float = 60.0) -> float | None:
    """Seconds to wait by a Retry-After header (seconds or a date), within 0 and ``most``; null if it cannot be read."""
    if not header:
        return None
    try:
        wait = float(header)
    except ValueError:
        try:
            wait = (parsedate_to_datetime(header) - (now or datetime.now(UTC))).total_seconds()
        except (TypeError, ValueError):
            return None
    return max(0.0, min(most, wait))


# What pages that keep their file from programs say, and the reason each stands for, in the order of the test.
LANDING_BLOCKS = (
    ("landing_antibot", ("anubis", "making sure you're not a bot")),
    ("landing_js_gate", ("grecaptcha", "recaptcha")),
    ("landing_js_gate", ("verificando sua sess", "enable javascript", "habilite o javascript")),
)


def landing_block(html: Column) -> Column:
    """The reason why a landing page does not show its file, or null."""
    low = F.lower(F.coalesce(html, F.lit("")))
    says = lambda marks: reduce(lambda a, b: a | b, [low.contains(m) for m in marks])
    return F.coalesce(*[F.when(says(marks), reason) for reason, marks in LANDING_BLOCKS])


def _hrefs(html: Column) -> Column:
    return F.regexp_extract_all(html, F.lit(r"(?is)<a\b[^>]*?\bhref\s*=\s*[\"']([^\"']+)[\"']"))


def landing_pdf(html: Column, base: Column) -> Column:
    """The file a landing page leads to: a bitstream link, the citation_pdf_url meta element, or a link that ends in .pdf."""
    low = lambda x: F.lower(x)
    stream = F.get(F.filter(_hrefs(html), lambda x: low(x).contains("bitstream") & (low(x).contains("download") | low(x).contains(".pdf"))), F.lit(0))
    meta = F.coalesce(
        F.nullif(F.regexp_extract(html, r"(?is)<meta\b[^>]*citation_pdf_url[^>]*?\bcontent\s*=\s*[\"']([^\"']+)[\"']", 1), F.lit("")),
        F.nullif(F.regexp_extract(html, r"(?is)<meta\b[^>]*?\bcontent\s*=\s*[\"']([^\"']+)[\"'][^>]*citation_pdf_url", 1), F.lit("")),
    )
    direct = F.get(F.filter(_hrefs(html), lambda x: low(F.regexp_replace(x, r"[?#].*$", "")).endswith(".pdf")), F.lit(0))
    return resolve_url(base, F.coalesce(stream, meta, direct))


@F.pandas_udf(T.StringType())
def resolve_url(base: pd.Series, link: pd.Series) -> pd.Series:
    return pd.Series([None if x is None else urljoin(b or "", x) for b, x in zip(base, link)])


def direct_pdf(urls: Column) -> Column:
    """The first address that names a PDF or a download."""
    return F.get(F.filter(texts_of(urls), lambda u: F.lower(u).rlike(r"\.pdf|download")), F.lit(0))


@F.pandas_udf(T.StringType())
def point_id(kind: pd.Series, key: pd.Series) -> pd.Series:
    """Stable UUID (version 5) of an index entry."""
    return pd.Series([str(uuid.uuid5(uuid.NAMESPACE_URL, f"{k}:{i}")) for k, i in zip(kind, key)])


def section_name(heading: Column) -> Column:
    """A heading without its number and the dashes and dots around it, at most 60 characters."""
    bare = F.regexp_replace(strip(heading), r"^[0-9]+(?:\.[0-9]+)*\.?\s+", "")
    bare = F.regexp_replace(F.regexp_replace(bare, r"^[ \-–—.]+|[ \-–—.]+$", ""), r"\s+", " ")
    return F.left(F.when(bare == "", "SEÇÃO").otherwise(bare), F.lit(60))


def is_heading(line: Column, most: int = 90) -> Column:
    """Chapter words, a number before a capital, or several words all in capitals, in at most ``most`` characters."""
    t = strip(line)
    shaped = t.rlike(r"(?iu)^(?:CAP[IÍ]TULO|PARTE|ANEXO|APÊNDICE)(?:[^\p{L}\p{N}_]|$)") | t.rlike(r"^[0-9]+(?:\.[0-9]+)*\.?\s+[A-ZÀ-Ú]")
    capitals = (F.upper(t) == t) & (F.lower(t) != t) & t.contains(" ")
    return F.coalesce((t != "") & (F.length(t) <= most) & (shaped | capitals), F.lit(False))


# What is asked of a chunk by the words its section has, tried in this order.
INSTRUCTIONS = (
    (("INTRODU", "INTRO"), "Resuma a introdução do documento intitulado {title}."),
    (("CONCLUSÃO", "CONSIDERAÇÕES FINAIS"), "Resuma a conclusão do documento intitulado {title}."),
    (("METODOLOGIA", "MÉTODO"), "Descreva a metodologia apresentada no documento intitulado {title}."),
    (("",), "Resuma o documento intitulado {title}."),
)


def instruction(title: Column, section: Column) -> Column:
    """What is asked of a chunk, by words of its section."""
    upper, chosen = F.upper(F.coalesce(section, F.lit(""))), []
    for marks, asked in INSTRUCTIONS:
        before, after = asked.split("{title}")
        told = F.concat(F.lit(before), F.coalesce(title, F.lit("")), F.lit(after))
        chosen.append(F.when(reduce(lambda a, b: a | b, [upper.contains(m) for m in marks]), told))
    return F.coalesce(*chosen)
