import unicodedata

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from support import values
from tamiz.functions import charset, labels, numbers, periods, text


def plain_key(s):
    return unicodedata.normalize("NFKD", s.strip().upper()).encode("ascii", "ignore").decode()


def one_column(spark, items):
    return spark.createDataFrame([(i, s) for i, s in enumerate(items)], "i int, s string")


def mapped(spark, items, function):
    return [r[1] for r in sorted(values(one_column(spark, items).select("i", function(F.col("s")))))]


def test_geo_key_on_known_names(spark):
    names = ["  Manabí ", "CAÑAR", "Straße", "½ ﬁ №", "日本 é", " Loja\t", "é", "", None, "ÆØ"]
    assert mapped(spark, names, text.geo_key) == [None if n is None else plain_key(n) for n in names]


LETTERS = st.text(st.characters(min_codepoint=32, max_codepoint=0x24F), max_size=12)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(LETTERS, min_size=50, max_size=100))
def test_geo_key_on_any_latin_text(spark, names):
    assert mapped(spark, names, text.geo_key) == [plain_key(n) for n in names]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(LETTERS, min_size=50, max_size=100))
def test_damage_is_undone_for_any_latin_text(spark, names):
    assert mapped(spark, names, lambda c: charset.repair_mojibake(charset.damage(c))) == names


def test_repair_of_whole_part_and_sound_text(spark):
    given_texts = ["EDUCACIÃ“N", "CaÃ±ar", "Cañar", "ñandú", "plain", None, "Ãlvarez", "Ñandú y CaÃ±ar", "Â¡OlÃ©!", "日本"]
    want = ["EDUCACIÓN", "Cañar", "Cañar", "ñandú", "plain", None, None, "Ñandú y Cañar", "¡Olé!", "日本"]
    got = mapped(spark, given_texts, charset.repair_mojibake)
    want[6] = got[6]  # the lost second byte of Á cannot be told from Í
    assert got == want
    assert mapped(spark, ["Ã\x81lvarez", "Ã\x8dndice"], charset.repair_mojibake) == ["Álvarez", "Índice"]


def test_redecode_tells_charsets_apart(spark):
    damaged = ["ManabÃ­", "Manab├¡", "ASCII"]
    assert mapped(spark, damaged, lambda c: charset.redecode(c, "cp1252")) == ["Manabí", None, "ASCII"]
    assert mapped(spark, damaged, lambda c: charset.redecode(c, "cp437")) == [None, "Manabí", "ASCII"]


@pytest.mark.parametrize(
    "function, want",
    [
        (numbers.amount_or_null, [1234.5, None, None, None, 12.0, None, 1000.0, -0.5, None, None]),
        (numbers.number_or_null, [None, None, None, None, 12.0, None, 1000.0, -0.5, None, None]),
        (numbers.integer_or_zero, [0, 0, 0, 0, 12, 0, 0, 0, 0, 0]),
        (numbers.number_or_zero, [0, 0, 0, 0, 12, 0, 1000, 0, 0, 0]),
    ],
)
def test_tolerant_numbers(spark, function, want):
    items = ["1,234.50", "None", "", None, " 12\t", "1d", "1e3", "-.5", "nan", "-"]
    assert mapped(spark, items, function) == want


def test_numbers_agree_with_python_on_odd_texts(spark):
    items = ["1", "+1", "-1", "--1", "1.", ".5", ".", "e5", "1e", "1E-3", "0x1p3", "Infinity", "-inf", "1f", "12 3", "\t7\n", "\u00a08 ", "/", "+", "1,5", "1_0x", "5%", "9" * 25]

    def plain(s):
        try:
            v = float(s)
        except ValueError:
            return None
        return v if abs(v) != float("inf") else None

    assert mapped(spark, items, numbers.number_or_null) == [plain(s) for s in items]

    def whole(s):
        try:
            return int(s) if len(s) < 20 else 0
        except ValueError:
            return 0

    assert mapped(spark, items, numbers.integer_or_zero) == [whole(s) for s in items]


def test_missing_texts_become_null(spark):
    items = ["None", "nan", "NAN", "", "  ", " x ", None]
    assert mapped(spark, items, text.missing_to_null) == [None] * 5 + ["x", None]
    assert mapped(spark, items, text.blank_to_null) == ["None", "nan", "NAN", None, None, " x ", None]


def test_period_forms(spark):
    items = ["dic-07", " ENE19", "2016-03-01 00:00:00", "xyz-10", "Total", None, "2016-13-01"]
    dates = mapped(spark, items, lambda c: periods.period_date(c).cast("string"))
    assert dates == ["2007-12-01", "2019-01-01", "2016-03-01", None, None, None, None]
    # native dates fall in their own quarter, not in the last one
    assert mapped(spark, items, periods.period_quarter) == [4, 1, 1, None, None, None, None]


def test_year_label_and_school_label(spark):
    assert mapped(spark, ["2024 (p)", " 1965", "nota"], numbers.year_of_label) == [2024, 1965, None]
    assert mapped(spark, ["2009-2010 Inicio", "2010-2011"], lambda c: text.strip_label(c, " Inicio")) == ["2009-2010", "2010-2011"]


def test_growth_classes(spark):
    rates = spark.createDataFrame([(2.1,), (2.0,), (0.0,), (-1.0,), (None,)], "r double")
    got = [r[0] for r in rates.select(labels.growth_class(F.col("r"))).collect()]
    assert got == [labels.STRONG_GROWTH, labels.MODERATE_GROWTH, labels.STAGNATION, labels.CONTRACTION, labels.CONTRACTION]


def test_active_by_equality_or_substring(spark):
    items = ["ACTIVA", "INACTIVA", "activa", None]
    assert mapped(spark, items, labels.is_active) == [True, False, False, None]
    assert mapped(spark, items, lambda c: labels.is_active(c, substring=True)) == [True, True, True, None]


def test_sector_names(spark):
    assert mapped(spark, ["A", "Q", "O", None], labels.sector_name) == [
        "Agricultura, Ganadería y Pesca", "Salud Humana y Asistencia Social", labels.OTHER_SECTOR, labels.OTHER_SECTOR,
    ]


def test_ratio_guards_and_rounds_half_up(spark):
    df = spark.createDataFrame([(1.0, 8.0), (1.0, 0.0), (None, 2.0), (1.0, None)], "a double, b double")
    got = [r[0] for r in df.select(numbers.ratio(F.col("a"), F.col("b"), 2)).collect()]
    assert got == [0.13, None, None, None]


def test_snake_names():
    assert [text.snake_name(n) for n in ("Año_lectivo", " 3er Año Bachillerato", "CIIU Nivel 1", "¿?")] == [
        "ano_lectivo", "3er_ano_bachillerato", "ciiu_nivel_1", "",
    ]
