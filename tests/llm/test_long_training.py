"""Languages that are labelled on long documents only."""

from newsloom.llm import langid


def test_every_labelled_language_has_a_dictionary(make_docs):
    english, french = "the dog and the cat sat on the mat ", "le chien est sur le tapis et le chat "
    docs = [(k, english * 3, "en") for k in range(30)]
    docs += [(100 + k, french * 400, "fr") for k in range(30)]
    docs += [(200 + k, "12 34 " * 2000 + "der hund und die katze ", "de") for k in range(3)]
    docs += [(1000 + k, "12 34", "es") for k in range(300)] + [(2000, "el perro y el gato", "es")]
    docs += [(None, "o cachorro e o gato", "pt"), (3000, "1 2", "xx")]
    made = langid.dictionaries(make_docs(*docs))
    assert set(made) == {"en", "fr", "de", "es", "pt"}
    assert all(len(held) <= langid.DICT_BYTES for held in made.values())
    rows = langid.predicted(make_docs((1, french), (2, english)), made).collect()
    assert [r["lang_pred"] for r in rows] == ["fr", "en"]
