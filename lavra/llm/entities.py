"""Variant spellings of the names of persons and institutions, linked by merge-and-rematch resolution.

Spellings become token sequences in one order (given names before surnames; kind of institution before place). A profile is a
set of merged spellings; from the fullest one come the forms under which the entity may be written: initials, a dropped
middle surname, an acronym. A spelling joins the profile if one profile alone has its form, exactly or but for one typing error in
a token that is rare or much rarer than the token it stands for, however large the table is. Merging completes profiles (a given name from one spelling, a surname from another), so after
each round the richer profiles give their forms again, until a round merges nothing.

Everything is joined on keys: no pairs are formed inside a block, so a frequent surname costs rows, not pairs of rows.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lavra.operators.components import connected_components
from lavra.session import durable

# Words that carry no identity, kinds of institutions with their English words, and nicknames.
_PARTICLES = {"de", "da", "do", "dos", "das", "del", "e", "y", "of", "the", "du", "des", "campus"}
_KINDS = ("universidade", "federal", "estadual", "instituto", "tecnologico", "centro", "universitario", "faculdade", "escola", "municipal", "catolica", "pontificia")
_ENGLISH = {
    "university": "universidade", "federal": "federal", "state": "estadual", "institute": "instituto", "technological": "tecnologico",
    "center": "centro", "centre": "centro", "college": "faculdade", "school": "escola", "catholic": "catolica", "pontifical": "pontificia",
}
_NICKNAMES = {
    "lipe": "felipe", "gabi": "gabriela", "tati": "tatiana", "teca": "teresa", "mari": "mariana", "bela": "isabela", "isa": "isabela",
    "lula": "luiz", "guto": "augusto", "guga": "gustavo", "gus": "gustavo", "chico": "francisco", "ze": "jose", "beto": "roberto", "dudu": "eduardo",
    "edu": "eduardo", "duda": "eduardo", "dani": "daniel", "rafa": "rafael", "leo": "leandro", "pri": "priscila", "ju": "juliana",
    "nanda": "fernanda", "carol": "carolina", "lari": "larissa", "bia": "beatriz", "nati": "natalia", "tonho": "antonio", "toninho": "antonio",
    "lena": "helena", "lu": "lucia", "pati": "patricia", "paty": "patricia", "quel": "raquel", "rico": "ricardo", "cadu": "carlos", "nando": "fernando", "rick": "ricardo",
    "kika": "francisca", "vivi": "viviane", "cris": "cristina", "fabi": "fabiana", "cacau": "claudia", "sil": "silvia", "tete": "teresa", "tiao": "sebastiao",
    "paulinho": "paulo", "marcinho": "marcio", "pedrinho": "pedro", "rosinha": "rosa", "luluca": "lucia", "mila": "camila", "nina": "marina", "vava": "vanessa",
    "van": "vanessa", "kiko": "henrique", "rique": "henrique", "juca": "jorge", "deb": "debora", "debi": "debora", "lili": "elisa", "nato": "renato",
    "re": "renata", "mau": "mauricio", "ti": "tiago", "vi": "vicente", "cela": "marcela", "celo": "marcelo", "mon": "simone", "si": "simone",
}
_WORDS = re.compile(r"[^\W\d_]+")
_ACRONYM = re.compile(r"^\W*([A-ZÀ-Ý]{3,10})\b(?:\s*[-–—]\s*(.*))?$|^(.*?)\s*\(([A-ZÀ-Ý]{3,10})\)\W*$", re.S)


def plain(text: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFKD", text.casefold()) if not unicodedata.combining(c))


def one_edit(a: str, b: str) -> bool:
    """Equal, or apart by one insertion, deletion, substitution or swap of neighbours."""
    if abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    return a[i:] == b[i:] or a[i + 1 :] == b[i:] or a[i:] == b[i + 1 :] or a[i + 1 :] == b[i + 1 :] or (a[i + 2 :] == b[i + 2 :] and a[i : i + 2] == b[i : i + 2][::-1])


def near_tokens(a: str, b: str):
    """``one_edit`` of two columns, without Python."""
    swapped = F.expr(f"exists(sequence(1, greatest(length({a}) - 1, 1)), i -> concat(left({a}, i - 1), substring({a}, i + 1, 1), substring({a}, i, 1), substring({a}, i + 2)) = {b})")
    return (F.levenshtein(a, b, 1) >= 0) | ((F.length(a) == F.length(b)) & (F.levenshtein(a, b, 2) == 2) & swapped)


def author_tokens(name: str) -> list[str]:
    """Given names, then surnames: what stands behind a comma goes first. A nickname gives ``~`` and the name it stands for."""
    before, comma, after = unicodedata.normalize("NFC", name).partition(",")
    words = [w for part in ((after, before) if comma else (before,)) for w in _WORDS.findall(part)]
    tokens = [plain(w) for w in words if plain(w) not in _PARTICLES or (len(w) == 1 and w.isupper())]
    if len(tokens) > 1 and tokens[0] in _NICKNAMES:
        return ["~" + _NICKNAMES[tokens[0]], *tokens[1:]]
    return tokens


def author_forms(tokens: list[str]) -> list[str]:
    """The forms of a full name of a given name, maybe a second one, and two surnames; of others only the name itself.

    Of a nickname with two surnames the initial is that of the name it stands for.
    """
    forms = [" ".join(tokens)]
    if author_full(tokens):
        g, (s1, s2) = tokens[:-2], tokens[-2:]
        first = g[0].lstrip("~")
        forms += [" ".join([*(x.lstrip("~")[0] for x in g), s1, s2]), f"{first[0]} {s1} {s2}"]
        if g[0][0] != "~":
            forms += [f"{first} {s1[0]} {s2}", f"{first} {s2}", f"~{first} {s1} {s2}", f"~{first} {s2}"]
            forms += [f"{first} {s1} {s2}"] * (len(g) > 1)
    return list(dict.fromkeys(forms))


def author_full(tokens: list[str]) -> bool:
    return 3 <= len(tokens) <= 4 and all(len(t.lstrip("~")) > 1 for t in tokens) and not any(t[0] == "~" for t in tokens[1:])


def author_bridge(tokens: list[str]) -> str | None:
    """Two incomplete spellings of one kind each that share this key complete one another: ``j silva souza``, ``jose s souza``."""
    if len(tokens) == 3 and tokens[0][0] != "~" and len(tokens[2]) > 1 and (len(tokens[0]) == 1) != (len(tokens[1]) == 1):
        return f"{tokens[0][0]} {tokens[1][0]} {tokens[2]}"
    return None


def _kind_word(word: str, dotted: bool) -> str | None:
    word = _ENGLISH.get(word, word)
    if word in _KINDS:
        return word
    if len(word) > 4:
        near = [k for k in _KINDS if one_edit(word, k)]
        if near:
            return near[0]
    return f"{word}." if dotted and any(k.startswith(word) for k in _KINDS) else None


def institution_tokens(name: str) -> tuple[list[str], str | None]:
    """Words of the kind in their usual order, then the place; and the acronym that the spelling gives, if any."""
    m = _ACRONYM.match(name.strip())
    acronym, body = ((m[1] or m[4]), (m[2] or m[3] or "")) if m else (None, name)
    if m and m[1] and not body and len(m[1]) > 10:
        acronym, body = None, name
    text = plain(body)
    kinds, place = [], []
    for m in re.finditer(r"([^\W\d_]+)(\.?)", text):
        word = m[1]
        if word in _PARTICLES:
            continue
        kind = _kind_word(word, bool(m[2]) and m.end() < len(text.rstrip()))
        (place if kind is None else kinds).append(word if kind is None else kind)
    if "centro" in kinds and "universidade" in kinds:  # "University Center"
        kinds = ["universitario" if k == "universidade" else k for k in kinds]
    full: list[str] = []
    for k in kinds:
        if k.endswith("."):
            fits = [x for x in _KINDS if x.startswith(k[:-1]) and x not in full]
            with_centro = any(x in ("c.", "cent.", "centr.", "centro") for x in kinds)
            pick = "universitario" if k.startswith("univ") and with_centro else ("universidade" if k.startswith("univ") else (fits[0] if fits else None))
            if k == "c.":
                pick = "centro"
            k = pick or k[:-1]
        full.append(k)
    return sorted(set(full), key=lambda k: (_KINDS.index(k) if k in _KINDS else 99, k)) + place, (acronym or "").lower() or None


def institution_forms(tokens: list[str]) -> list[str]:
    forms = [" ".join(tokens)]
    if institution_full(tokens):
        kinds, place = [t for t in tokens if t in _KINDS], [t for t in tokens if t not in _KINDS]
        if "universitario" in kinds:
            kinds = ["centro", "universitario"]
        for n in range(1, 5):
            acronym = "".join(k[0] for k in kinds) + "".join(p[0] for p in place[:-1]) + place[-1][:n]
            forms += [f"={acronym}", f"={acronym} {' '.join(place)}"]
    return list(dict.fromkeys(forms))


def institution_full(tokens: list[str]) -> bool:
    return any(t in _KINDS for t in tokens) and any(t not in _KINDS for t in tokens)


def read_name(kind: str, name: str) -> list[str]:
    if kind == "author":
        return author_tokens(name)
    tokens, acronym = institution_tokens(name)
    if acronym and not institution_full(tokens):
        return [f"={acronym}", *tokens]
    return tokens


def forms_of(kind: str, tokens: list[str]) -> list[str]:
    return author_forms(tokens) if kind == "author" else institution_forms(tokens)


def is_full(kind: str, tokens: list[str]) -> bool:
    return author_full(tokens) if kind == "author" else institution_full(tokens)


def repaired(kind: str, name: str) -> set[str]:
    """Readings of a spelling whose blank or comma stands one letter off or is missing, or with a mistyped particle left out."""
    found = set()
    for i in range(1, len(name)):
        a, b = name[i - 1], name[i]
        if a.isalpha() != b.isalpha():
            found.add(name[: i - 1] + b + a + name[i + 1 :])
        elif a.isalpha() and b.isalpha():
            found |= {name[:i] + " " + name[i:], name[: i - 1] + " " + name[i:]}
    for m in _WORDS.finditer(name):
        w = plain(m[0])
        if 2 <= len(w) <= 4 and w not in _PARTICLES and any(len(q) > 1 and one_edit(w, q) for q in _PARTICLES):
            found.add(name[: m.start()] + name[m.end() :])
    return {" ".join(t) for t in (read_name(kind, x) for x in found) if len(t) >= 2} - {""}


def _gaps(tokens: list[str], wanted: set[str] | None = None) -> list[tuple[str, str]]:
    """(The tokens with one left open, the token left open); ``wanted`` limits the open ones. Acronyms are never left open."""
    return [(" ".join([*tokens[:i], "?", *tokens[i + 1 :]]), t) for i, t in enumerate(tokens) if len(t) > 2 and t[0] not in "=~" and (wanted is None or t in wanted)]


def _rows(df: DataFrame, schema: str, make) -> DataFrame:
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [row for values in zip(*(c.to_pylist() for c in b.columns)) for row in make(*values)]
            columns = list(zip(*out)) if out else [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.list_(pa.string()) if "array" in s else pa.string()) for c, s in zip(columns, schema.split(", "))], names=names)

    return df.mapInArrow(run, schema)


def _keyed(df: DataFrame) -> DataFrame:
    """``df`` as the side of a join whose both sides go to their keys: small sides sent to all executors, a hundred of them, would go through the driver."""
    return df.hint("merge")


#: A token in at most so many readings may be a typing error of any other token.
RARE = 2
#: A token in any number of readings may be a typing error of tokens that are at least so many times as frequent.
SLIP_RATIO = 8


def _slips(known: DataFrame, particles: DataFrame) -> DataFrame:
    """``k, token, others`` of the tokens in ``known`` that may be typing errors, and of which ones; null for any.

    Such are rare tokens; those near tokens or particles that are much more frequent; and two such tokens written as one.
    """
    much = F.col("m") >= SLIP_RATIO * F.col("n")
    shorter = lambda c: F.expr(f"explode(array_distinct(concat(array({c}), transform(sequence(1, length({c})), i -> concat(left({c}, i - 1), substring({c}, i + 1))))))")
    likely = known.unionAll(particles).where("length(token) > 1").select("k", F.col("token").alias("other"), F.col("n").alias("m"))
    frequent = known.where(F.col("n") > RARE)
    # tokens one edit apart are the same, or lose one letter to become the same
    near = frequent.where("length(token) > 1").withColumn("part", shorter("token")).join(_keyed(likely.where(F.col("m") > RARE * SLIP_RATIO).withColumn("part", shorter("other"))), ["k", "part"])
    near = near.where(much).where(near_tokens("token", "other")).select("k", "token", "other")
    halves = frequent.where("length(token) > 3").withColumn("at", F.expr("explode(sequence(2, length(token) - 2))"))
    halves = halves.withColumn("other", F.expr("explode(array(left(token, at), substring(token, at + 1)))")).join(_keyed(likely), ["k", "other"]).where(much)
    halves = halves.groupBy("k", "token", "at").agg(F.count(F.lit(1)).alias("found")).where("found = 2").select("k", "token", F.lit(None).cast("string").alias("other"))
    found = near.unionAll(halves).groupBy("k", "token").agg(F.collect_set("other").alias("others"))
    return found.unionAll(known.where((F.col("n") <= RARE) & (F.length("token") > 1)).select("k", "token", F.lit(None).cast("array<string>")))


#: Up to so many links are united in one task, whose memory they bound; more of them in steps over all executors.
UNITED_LINKS = 50_000


def _united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``entity, component`` of the ends of all these links; ``component`` is the least entity connected to it."""
    over: dict[str, str] = {}

    def top(x: str) -> str:
        while (up := over.setdefault(x, x)) != x:
            over[x] = x = over[up]
        return x

    for b in batches:
        for x, y in zip(*(c.to_pylist() for c in b.columns)):
            x, y = top(x), top(y)
            over[max(x, y)] = min(x, y)
    yield pa.RecordBatch.from_arrays([pa.array(list(over), pa.string()), pa.array([top(x) for x in list(over)], pa.string())], names=["entity", "component"])


def _merged(edges: DataFrame, n: int) -> DataFrame:
    """``entity, component`` for the entities that these ``n`` links ``ea, eb`` merge."""
    if n <= UNITED_LINKS:
        return F.broadcast(edges.coalesce(1).mapInArrow(_united, "entity string, component string"))
    return connected_components(edges, "ea", "eb").select(F.col("node").alias("entity"), "component")


def link_names(names: DataFrame) -> DataFrame:
    """``kind, name, entity`` for every distinct spelling in ``names`` (``kind`` author or institution, ``name``).

    Null and blank names have no rows; names without letters, and names that fit no other, are entities of their own; a spelling that fits several entities is linked to none
    of them. ``entity`` is the least reading of the entity's spellings.
    """
    spelled = names.where("name is not null and trim(name) <> ''").select("kind", "name").distinct()
    read = durable(_rows(spelled, "kind string, name string, canon string", lambda k, n: [(k, n, f"{k[0]}|{' '.join(read_name(k, n)) or '#' + n}")]))
    canons = durable(read.select("canon").distinct())
    split = lambda canon: (("author" if canon[0] == "a" else "institution"), canon[2:].split(" "))
    tokens = canons.select(F.substring("canon", 1, 1).alias("k"), F.explode(F.array_distinct(F.split(F.expr("substring(canon, 3)"), " "))).alias("token"))
    known = durable(tokens.groupBy("k", "token").agg(F.count(F.lit(1)).alias("n")))
    per = canons.select("canon", F.substring("canon", 1, 1).alias("k"), F.explode(F.array_distinct(F.split(F.expr("substring(canon, 3)"), " "))).alias("token"))
    small = _rows(spelled, "k string, token string", lambda k, n: [(k[0], w) for w in {plain(w) for w in _WORDS.findall(n)} if w in _PARTICLES])
    small = small.groupBy("k", "token").agg(F.count(F.lit(1)).alias("n"))
    slips = durable(_slips(known, small))
    rare = per.join(_keyed(slips), ["k", "token"]).groupBy("canon").agg(F.collect_list("token").alias("rare"))
    base = durable(canons.join(_keyed(rare), "canon", "left"))
    suspects = base.where("rare is not null")

    # Readings of misplaced blanks, and readings with a rare token left open; both computed once. So are the forms that a mistyped full
    # name has: these meet only what no full name owns, for two mistyped persons may share a form.
    def keys_of(c: str, reading: str) -> list[tuple[str, str, str]]:
        kind, tokens = split(f"{c[0]}|{reading}")
        return [(c, f"{c[:2]}{f}", "y" if i else "n") for i, f in enumerate(forms_of(kind, tokens) if is_full(kind, tokens) else [reading])]

    fixes = durable(
        read.join(_keyed(suspects.select("canon")), "canon", "left_semi").select("kind", "name", "canon").transform(
            lambda d: _rows(d, "kind string, canon string, key string, derived string", lambda k, n, c: [(k, *x) for r in repaired(k, n) for x in keys_of(c, r)])
        ).select("canon", "key", "derived").where("canon <> key").distinct()
    )
    gaps = durable(_rows(suspects.select("canon", "rare"), "canon string, gap string, token string, derived string",
                         lambda c, r: [(c, f"{c[:2]}{g}", t, d) for _, f, d in keys_of(c, c[2:]) for g, t in _gaps(split(f)[1], set(r))])
                   .withColumn("k", F.substring("canon", 1, 1)).join(_keyed(slips), ["k", "token"]))

    def level(c: str, form: int) -> str:
        kind, tokens = split(c)
        return "0" if not is_full(kind, tokens) else ("1" if form else "0") if tokens[0][0] == "~" else "2"

    def forms_made(sources: DataFrame) -> DataFrame:
        make = lambda c, f, late: [(f, c[:2] + x, level(c, i), late) for i, x in enumerate(forms_of(*split(c)))]
        return durable(_rows(sources.select("canon", "from", "late"), "from string, form string, full string, late string", make))

    def meetings(formed: DataFrame) -> DataFrame:
        """``a, form, near, weak``: the readings that have one of these forms, exactly or but for an error, whoever holds it."""
        form = formed.select("form").distinct()
        opened = _rows(form, "form string, gap string, other string", lambda f: [(f, f"{f[:2]}{g}", t) for g, t in _gaps(split(f)[1])])
        exact = base.join(_keyed(form), F.col("canon") == F.col("form")).select(F.col("canon").alias("a"), "form", F.lit(False).alias("near"), F.lit("n").alias("derived"))
        shifted = fixes.join(_keyed(form), F.col("key") == F.col("form")).select("canon", "form", F.lit(True), "derived")
        typed = (
            gaps.join(_keyed(opened), "gap").where((F.col("token") != F.col("other")) & (F.abs(F.length("token") - F.length("other")) <= 1))
            .where(F.col("others").isNull() | F.array_contains("others", F.col("other"))).where(near_tokens("token", "other")).select("canon", "form", F.lit(True), "derived")
        )
        return durable(exact.unionAll(shifted).unionAll(typed).select("a", "form", "near", (F.col("derived") == "y").alias("weak")))

    # What does not change from round to round is computed once: the forms, which readings meet them, which could complete one another
    formed = forms_made(base.select("canon", F.col("canon").alias("from"), F.when(F.col("rare").isNull(), "n").otherwise("y").alias("late")))
    met = meetings(formed)

    def label(c: str) -> list[tuple]:
        tokens = split(c)[1]
        bridge = author_bridge(tokens) if c[0] == "a" else None
        return [(c, c, "y" if is_full(*split(c)) else "n", bridge, bridge and ("g" if len(tokens[0]) > 1 else "s"))]

    labels = durable(_rows(base.select("canon"), "canon string, entity string, whole string, bridge string, side string", label))
    pending, settled = None, False
    while True:  # every round merges entities, or is the last but one
        held = (formed if settled else formed.where("late = 'n'")).join(_keyed(labels.select(F.col("canon").alias("from"), "entity")), "from")
        # a form that some full name has belongs to that name, or else to a nickname with all surnames; else it may only be met by a typing error
        of_level = lambda f: F.coalesce(*[f(F.when(F.col("full") == v, F.col("entity"))) for v in "210"])
        held = held.groupBy("form").agg(of_level(F.min).alias("entity"), of_level(F.max).alias("other"), (F.max("full") > "0").alias("owned")).where("entity = other")
        links = met.join(_keyed(held), "form").where("not (weak and owned)").join(_keyed(labels.select(F.col("canon").alias("a"), F.col("entity").alias("own"))), "a").where("entity <> own")
        near = F.when(F.col("near"), F.col("entity"))
        links = links.groupBy("a", "own").agg(F.min(F.when(~F.col("near"), F.col("entity"))).alias("exact"), F.min(near).alias("x"), F.max(near).alias("y"))
        links = links.select(F.col("own").alias("ea"), F.explode(F.array("exact", F.when(F.col("x") == F.col("y"), F.col("x")))).alias("eb")).where("eb is not null")
        # entities are contracted, not spellings: the first round has most of the work
        edges = durable((links if pending is None else links.unionAll(pending.select("ea", "eb"))).distinct())
        merged = edges.count()
        if merged:
            parts = _merged(edges, merged)
            labels = durable(labels.join(parts, "entity", "left").select("canon", F.coalesce("component", "entity").alias("entity"), "whole", "bridge", "side"))
        bridged = False
        if merged or pending is None:  # rematch: incomplete profiles that complete one another give new full names
            open_ = labels.withColumn("complete", F.max("whole").over(Window.partitionBy("entity"))).where("bridge is not null and complete = 'n'")
            side = lambda f, v, c: f(F.when(F.col("side") == v, F.col(c)))
            sides = open_.groupBy("bridge").agg(side(F.count, "g", "canon").alias("g"), side(F.count, "s", "canon").alias("s"), side(F.min, "g", "canon").alias("a"), side(F.min, "s", "canon").alias("b"),
                                                side(F.min, "g", "entity").alias("ea"), side(F.min, "s", "entity").alias("eb")).where("g = 1 and s = 1")
            pending = durable(sides.where("ea <> eb").select("a", "b", "ea", "eb"))
            bridged = not pending.isEmpty()
        if bridged:  # merged in the next round
            full = F.concat(F.substring_index("a", " ", 1), F.lit(" "), F.expr("substring(b, instr(b, ' ') + 1)"))
            fuller = forms_made(pending.select(full.alias("canon"), F.col("a").alias("from"), F.lit("n").alias("late")))
            formed, met = formed.unionAll(fuller), met.unionAll(meetings(fuller))
        if not merged and not bridged:
            if settled:
                break
            settled = True  # mistyped names give their forms now, too
    return read.join(labels, "canon").select("kind", "name", "entity")


def spelling_pairs(linked: DataFrame) -> DataFrame:
    """``kind, a, b``: all pairs ``a < b`` of different spellings of one entity."""
    x, y = linked.alias("x"), linked.alias("y")
    same = (F.col("x.kind") == F.col("y.kind")) & (F.col("x.entity") == F.col("y.entity")) & (F.col("x.name") < F.col("y.name"))
    return x.join(y, same).select("x.kind", F.col("x.name").alias("a"), F.col("y.name").alias("b"))
