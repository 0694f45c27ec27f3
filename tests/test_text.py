import pytest

from bidtrail.functions.stemming import stem
from bidtrail.operators import text

# Word and stem pairs published with the algorithm, one or more of every step.
SAMPLES = (
    "caresses caress ponies poni ties ti caress caress cats cat feed feed agreed agre plastered plaster bled bled motoring motor "
    "sing sing conflated conflat troubled troubl sized size hopping hop tanned tan falling fall hissing hiss fizzed fizz failing fail "
    "filing file happy happi sky sky relational relat conditional condit rational ration valenci valenc hesitanci hesit digitizer digit "
    "conformabli conform radicalli radic differentli differ vileli vile analogousli analog vietnamization vietnam predication predic "
    "operator oper feudalism feudal decisiveness decis hopefulness hope callousness callous formaliti formal sensitiviti sensit "
    "sensibiliti sensibl triplicate triplic formative form formalize formal electriciti electr electrical electr hopeful hope goodness good "
    "revival reviv allowance allow inference infer airliner airlin gyroscopic gyroscop adjustable adjust defensible defens irritant irrit "
    "replacement replac adjustment adjust dependent depend adoption adopt homologou homolog communism commun activate activ "
    "angulariti angular homologous homolog effective effect bowdlerize bowdler probate probat rate rate cease ceas controll control roll roll "
    "generalizations gener oscillators oscil is is by by y y ll ll"
).split()


@pytest.mark.parametrize(("word", "expected"), list(zip(SAMPLES[::2], SAMPLES[1::2])))
def test_published_samples(word, expected):
    assert stem(word) == expected


def test_positions_and_stems(spark):
    df = spark.createDataFrame([(1, "The running of RUNNERS, and runs"), (2, ""), (3, None), (4, "the"), (5, "Ähren ähren"), (6, "x " * 5000)], "id int, t string")
    got = sorted(map(tuple, text.analysed_terms(df, "t").where("id < 6").select("id", "position", "term", "stem").collect()))
    assert got == [(1, 2, "running", "run"), (1, 4, "runners", "runner"), (1, 6, "runs", "run"), (5, 1, "ähren", "ähren"), (5, 2, "ähren", "ähren")]
    assert text.token_positions(df, "t").where("id = 6").count() == 5000


def test_rows_matching(spark):
    df = spark.createDataFrame([(1, "hopping horses"), (2, "a horse hops and hopped"), (3, "horse"), (4, None)], "id int, t string")
    found = text.rows_matching(text.analysed_terms(df, "t"), "id", "the Horse hops")
    assert sorted(map(tuple, found.collect())) == [(1, 2), (2, 3)]
    assert text.rows_matching(text.analysed_terms(df, "t"), "id", "the").collect() == []
