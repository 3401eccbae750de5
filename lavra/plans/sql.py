"""Pieces of SQL that say in DuckDB what the column functions say in Spark; the oracles are put together from them."""

from __future__ import annotations

from lavra.functions import scalars, text
from lavra.operators import quality, redaction, retrieval


def quoted(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def replaced(x: str, pattern: str, into: str) -> str:
    return f"regexp_replace({x}, {quoted(pattern)}, {into}, 'g')"


def strip(x: str) -> str:
    return replaced(x, r"^\s+|\s+$", "''")


def nonblank(x: str) -> str:
    return f"nullif({strip(x)}, '')"


def clean_whitespace(x: str) -> str:
    x = replaced(x, r"\r\n?", "chr(10)")
    x = replaced(x, r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]", "''")
    x = replaced(replaced(x, r"[ \t]+\n", "chr(10)"), r"\n[ \t]+", "chr(10)")
    return replaced(replaced(x, r"[ \t]{2,}", "' '"), r"\n{3,}", "chr(10)||chr(10)")


def lines(x: str) -> str:
    return f"string_split({x}, chr(10))"


def words(x: str) -> str:
    return rf"regexp_extract_all(lower({x}), '[\p{{L}}\p{{N}}_]+')"


def plain(x: str) -> str:
    accents = f"translate(lower({x}), '{scalars._ACCENTED}', '{scalars._BASE}')"
    return strip(replaced(replaced(accents, r"\p{M}+", "''"), r"\s+", "' '"))


def informed(x: str) -> str:
    t = strip(f"coalesce({x}, '')")
    return f"CASE WHEN {plain(t)} = '{scalars.NOT_INFORMED}' THEN '' ELSE {t} END"


def split_values(x: str) -> str:
    return f"list_filter(list_transform(string_split(coalesce({x}, ''), '||'), lambda v: {informed('v')}), lambda v: v <> '')"


def flags(pattern: str) -> str:
    """A pattern of ours in the other dialect: case is folded in Unicode there without a flag."""
    return quoted(pattern.replace("(?iu)", "(?i)"))


def matches(x: str, pattern: str) -> str:
    return f"regexp_matches({x}, {flags(pattern)})"


def year(x: str) -> str:
    return f"regexp_extract(coalesce({x}, ''), '([0-9]{{4}})', 1)"


def iso_date(x: str) -> str:
    t = strip(f"coalesce({x}, '')")
    return (
        f"CASE WHEN regexp_matches({t}, '^[0-9]{{4}}(-[0-9]{{2}})?(-[0-9]{{2}})?$') THEN {t} "
        f"WHEN regexp_matches({t}, '^[0-9]{{2}}/[0-9]{{2}}/[0-9]{{4}}$') THEN regexp_replace({t}, '^(..)/(..)/(....)$', '\\3-\\2-\\1') "
        f"WHEN regexp_matches({t}, '^[0-9]{{4}}/[0-9]{{2}}/[0-9]{{2}}$') THEN replace({t}, '/', '-') ELSE '' END"
    )


def language_code(x: str) -> str:
    cases = " ".join(f"WHEN lower({strip(x)}) IN ({', '.join(map(quoted, labels))}) THEN '{code}'" for code, labels in scalars.LANGUAGE_LABELS.items())
    return f"CASE {cases} ELSE '' END"


def canonical_url(x: str) -> str:
    t = strip(x)
    part = lambda i: rf"regexp_extract({t}, '^(?i)(https?)://(?:[^/?#]*@)?([^/?#@]+)([^?#]*)(\?[^#]*)?', {i})"
    path = f"CASE WHEN {part(3)} = '' THEN '/' ELSE {part(3)} END"
    return f"CASE WHEN {part(2)} = '' THEN {t} ELSE lower({part(1)}) || '://' || lower({part(2)}) || {path} || regexp_replace({part(4)}, '^\\?$', '') END"


def urls_in(x: str) -> str:
    found = rf"regexp_extract_all(coalesce({x}, ''), '(?i:https?)://[^\s|<>\"'']+')"
    trimmed = rf"list_filter(list_transform({found}, lambda u: regexp_replace(u, '[.,;:)\]}}]+$', '')), lambda u: regexp_matches(u, '^(?i:https?)://[^/?#]+'))"
    return f"(SELECT list_filter(t, lambda u, i: list_position(k, k[i]) = i) FROM (SELECT t, list_transform(t, lambda u: {canonical_url('u')}) AS k FROM (SELECT {trimmed} AS t)))"


def language(w: str, target: str = "pt", least: float = 0.1) -> str:
    """A struct of code and confidence over the list of words ``w``."""
    hits = {c: f"len(list_filter({w}, lambda z: z IN ({', '.join(map(quoted, p))})))" for c, p in quality.PROFILES.items()}
    return "[" + ", ".join(f"{{'hits': {h}, 'code': '{c}'}}" for c, h in hits.items()) + "]"


def repetition(w: str) -> str:
    runs = f"list_transform(range(0, len({w}) - 4), lambda i: array_to_string(list_slice({w}, i + 1, i + 5), ' '))"
    return f"CASE WHEN len({w}) <= 5 THEN 0.0 ELSE 1 - len(list_distinct({runs})) / (len({w}) - 4) END"


def junk(x: str) -> str:
    return f"CASE WHEN length({x}) = 0 THEN 1.0 ELSE length({replaced(x, quality.NO_JUNK, chr(39) * 2)}) / length({x}) END"


def bucket(x: str) -> str:
    return "CASE " + " ".join(f"WHEN {x} < {m} THEN '{label}'" if m else f"WHEN {x} IS NOT NULL THEN '{label}'" for m, label in quality.BUCKETS) + " END"


def redacted(x: str) -> str:
    for name, pattern in redaction.PATTERNS:
        x = replaced(x, pattern, quoted(f"<<{name}>>"))
    return x


def counts(x: str) -> list[tuple[str, str]]:
    """(kind, number of matches in the text as the kinds before left it)."""
    out = []
    for name, pattern in redaction.PATTERNS:
        out.append((name, f"len(regexp_extract_all({x}, {quoted(pattern)}))"))
        x = replaced(x, pattern, quoted(f"<<{name}>>"))
    return out


def heading(x: str) -> str:
    t = strip(x)
    shaped = f"({matches(t, text_chapter)} OR regexp_matches({t}, '^[0-9]+(?:\\.[0-9]+)*\\.?\\s+[A-ZÀ-Ú]'))"
    return f"({t} <> '' AND length({t}) <= 90 AND ({shaped} OR (upper({t}) = {t} AND lower({t}) <> {t} AND contains({t}, ' '))))"


text_chapter = r"(?i)^(?:CAP[IÍ]TULO|PARTE|ANEXO|APÊNDICE)(?:[^\p{L}\p{N}_]|$)"


def section_name(x: str) -> str:
    bare = f"regexp_replace({strip(x)}, '^[0-9]+(?:\\.[0-9]+)*\\.?\\s+', '')"
    bare = replaced(replaced(bare, r"^[ \-–—.]+|[ \-–—.]+$", "''"), r"\s+", "' '")
    return f"left(CASE WHEN {bare} = '' THEN 'SEÇÃO' ELSE {bare} END, 60)"


def instruction(title: str, section: str) -> str:
    cases = []
    for marks, asked in scalars.INSTRUCTIONS:
        test = " OR ".join(f"contains(upper(coalesce({section}, '')), {quoted(m)})" for m in marks)
        cases.append(f"WHEN {test} THEN replace({quoted(asked)}, '{{title}}', coalesce({title}, ''))")
    return f"CASE {' '.join(cases)} END"


def terms(x: str) -> str:
    return f"list_filter({words(plain(x))}, lambda z: z NOT IN ({', '.join(map(quoted, retrieval.STOP_WORDS))}))"


CHAPTER, REFERENCES, PAGE_NUMBER = text.CHAPTER, text.REFERENCES, text.PAGE_NUMBER
