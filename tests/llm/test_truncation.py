from lavra.llm.truncation import assess_endings, ending, open_marks, truncation_by_source


def test_dots_after_words_that_seldom_end_sentences_are_cuts(spark):
    inside = [(k, f"O painel usa uma entrevista digital de {w} pessoas.") for k, w in enumerate(["dez", "vinte", "trinta", "quarenta", "cem", "mil"])]
    ends = [(10 + k, f"O grupo {w} fez a entrevista digital. Os resultados vieram dos dados.") for k, w in enumerate(["um", "dois", "outro"])]
    asked = [(20, "O painel da escola usa uma entrevista digital..."), (21, "Os resultados da escola vieram dos dados...")]
    # once more for dots: a sentence end that stands inside a text
    more = [(30 + k, f"Tudo veio dos dados. O grupo {w} leu.") for k, w in enumerate(["um", "dois"])]
    df = spark.createDataFrame([(k, "s", t) for k, t in inside + ends + asked + more], "doc_id long, source string, text string")
    cut = {r["doc_id"] for r in assess_endings(df, "doc_id", "text", "source").where("cut").collect()}
    assert cut == {20}


def test_the_automaton_decides_texts_that_end_in_a_full_stop():
    whole = ['Ele disse "tudo bem" e saiu.', "Um (dois [três]).", "Veja <i>isto</i> agora.", "O campo <<PERSON>> e o termo <s> ficam.", "“Sim”. Não.", "A “b.\n\nOutro parágrafo."]
    cut = ['He said "this is open.', "Um (dois três.", "A <i>unclosed one closes.", "<b>Título\n\nOutro parágrafo.", "Nas palavras “da fonte."]
    assert [ending(t)[0] for t in whole] == ["complete"] * len(whole)
    assert [ending(t)[0] for t in cut] == ["open"] * len(cut)
    assert open_marks("( [ “ <i>") == 4 and open_marks(") ] ”") == 0


def test_ends_that_need_no_corpus():
    long_ = "Esta frase tem muitas palavras e vai bem além do que um título teria, com a intenção de mostrar o corte que veio depois. E outra "
    assert ending(long_ + "frase com um�")[0] == "broken" and ending(long_ + "frase com &am")[0] == "broken"
    assert ending(long_ + "frase […]")[0] == "omitted" and ending(long_ + "frase de uma")[0] == "inside"
    assert ending(None)[0] == ending(" \n")[0] == "blank" and ending("Título apenas")[0] == "furniture"
    assert ending(long_ + "frase.\nPorto Quirino, 2020")[0] == "furniture" and ending(long_ + "frase.\n12")[0] == "furniture"


def test_shares_by_source_with_nulls_repeats_and_clashing_columns(spark):
    cut = "Uma frase longa que tem mais do que cem letras para não ser tomada por título. E ainda uma outra frase que para no meio da pala"
    rows = [(1, "a", "Inteiro.", 0), (1, "a", "Inteiro.", 0), (2, "a", cut, 0), (3, None, None, 0), (4, None, "", 0), (5, "b", "Fim.", 0)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string, words int")
    got = assess_endings(df, "doc_id", "text", "source")
    assert {(r["source"], r["texts"], r["cut_texts"]) for r in truncation_by_source(got).collect()} == {("a", 3, 1), (None, 2, 0), ("b", 1, 0)}
    assert assess_endings(df.limit(0), "doc_id", "text", "source").count() == 0
