from lavra.llm import entities as module
from lavra.llm.entities import link_names, one_edit, spelling_pairs
from lavra.operators.components import connected_components

SURNAMES = [a + b for a in ("baro", "celu", "dimo", "fuxa", "gare", "hobi") for b in ("nalva", "rigo", "tesco", "vurno", "zezzi")]


def entities(spark, names, kind="author"):
    rows = link_names(spark.createDataFrame([(kind, n) for n in names], "kind string, name string")).collect()
    return {r["name"]: r["entity"] for r in rows}


def test_a_misspelling_of_several_persons_is_linked(spark):
    persons = [f"Antonio {a.title()} {b.title()}" for a, b in zip(SURNAMES, SURNAMES[7:] + SURNAMES[:7])]
    wrong = [p.replace("Antonio", "Antnoio") for p in persons[:3]]  # in three readings, a tenth of the right one's
    found = entities(spark, persons + wrong)
    assert all(found[w] == found[p] for w, p in zip(wrong, persons))
    assert len({found[p] for p in persons}) == len(persons)


def test_names_of_like_frequency_stay_apart_and_kinds_of_variants_are_linked(spark):
    pairs = list(zip(SURNAMES[:6], SURNAMES[9:15]))
    names = [f"{g} {a.title()} {b.title()}" for g in ("Renata", "Renato") for a, b in pairs]
    variants = ["Xanalva Yorigo, Felipe", "XANALVA YORIGO, Felipe", "F. Xanalva Yorigo", "Felipe X. Yorigo", "Lipe Xanalva Yorigo", "Yorigo, Felipe"]
    # no full name without an error: the initial belongs to the mistyped one; a nickname owns its initial
    odd = [["Veundulta Ulvilzezzi, Helena", "H. Velundulta Ulvilzezzi"], ["Teca Frompeche Zuluzafe", "Frompeche Zuluzafe, T."], ["Jorge Bruno Chancheco Pirotame", "Chancheco Pirotaem, Jorge"]]
    found = entities(spark, [*names, *variants, *[n for pair in odd for n in pair], "", "  ", None, "123"])
    assert len({found[n] for n in names}) == len(names)
    assert len({found[v] for v in variants}) == 1
    assert all(found[a] == found[b] for a, b in odd) and len({found[a] for a, _ in odd}) == 3
    assert "" not in found and None not in found and "123" in found


def test_institutions_and_pairs(spark):
    names = ["Universidade Federal de Porto Zumbá", "UNIVERSIDADE FEDERAL DE PORTO ZUMBA", "Univ. Fed. de Porto Zumbá", "Federal University of Porto Zumbá", "Universidade Estadual de Porto Zumbá"]
    found = entities(spark, names, "institution")
    assert len({found[n] for n in names[:4]}) == 1 and found[names[4]] != found[names[0]]
    linked = spark.createDataFrame([("author", n, e) for n, e in [("b", "1"), ("a", "1"), ("c", "2")]], "kind string, name string, entity string")
    assert [tuple(r) for r in spelling_pairs(linked).collect()] == [("author", "a", "b")]
    assert link_names(linked.select("kind", "name").limit(0)).count() == 0


def test_one_edit():
    assert one_edit("abc", "acb") and one_edit("abc", "ab") and one_edit("abc", "xbc") and not one_edit("abc", "xyc")


def test_rounds_take_few_jobs(spark):
    """Each exchange holds a thread of the driver for a minute: with hundreds of them a small table took more of its memory than a large one."""
    persons = [f"Antonio {a.title()} {b.title()}" for a, b in zip(SURNAMES, SURNAMES[7:] + SURNAMES[:7])]
    halves = ["J. Xanalva Yorigo", "Jorge X. Yorigo"]  # complete one another
    begun = (jobs := spark.sparkContext._jsc.sc().dagScheduler().numTotalJobs)()
    found = entities(spark, [*persons, *[p.replace("Antonio", "Antnoio") for p in persons[:3]], *halves])
    assert jobs() - begun < 130
    assert len({found[n] for n in halves}) == 1 and len(set(found.values())) == len(persons) + 1


def test_links_are_united_alike_in_one_task_and_in_steps(spark, monkeypatch):
    persons = [f"{g} {a.title()} {b.title()}" for g in ("Antonio", "Renata") for a, b in zip(SURNAMES[:8], SURNAMES[7:15])]
    names = [*persons, *[p.replace("Antonio", "A.").replace("Renata", "R.") for p in persons], *[p.replace("Antonio", "Antnoio") for p in persons], "J. Xanalva Yorigo", "Jorge X. Yorigo"]
    steps = []
    monkeypatch.setattr(module, "connected_components", lambda *a: steps.append(a) or connected_components(*a))
    found = entities(spark, names)
    assert not steps
    monkeypatch.setattr(module, "UNITED_LINKS", 0)
    assert entities(spark, names) == found and steps
    links = spark.createDataFrame([("b", "a"), ("c", "d"), ("d", "b"), ("y", "x"), ("c", "a"), ("z", "y")], "ea string, eb string")
    monkeypatch.undo()
    alike = [{(r[0], r[1]) for r in module._merged(links, n).collect()} for n in (6, module.UNITED_LINKS + 1)]
    assert alike[0] == alike[1] == {("a", "a"), ("b", "a"), ("c", "a"), ("d", "a"), ("x", "x"), ("y", "x"), ("z", "x")}
