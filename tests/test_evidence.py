import datetime as dt

import pytest
from pyspark.sql import functions as F

from fundscape.operators import costs as C, evidence as E


def value(spark, column, text=None):
    return spark.createDataFrame([(text,)], "t string").select(column.alias("v")).collect()[0]["v"]


BLACK = """Entry cost is 9% at most, says the narrative.
|||Costes de entrada|||9,00%|||99 EUR|||
|||Costes a lo largo del tiempo|||
|||Inversión: 10.000 EUR|||En caso de salida después de 1 año|||En caso de salida después del período de mantenimiento recomendado|||
|||Costes totales|||10 EUR|||1.100 EUR|||
|||Incidencia anual de los costes (*)|||0,10%|||1,82%|||
|||Composición de los costes|||
|||Costes de entrada|||Hasta el 3,50% del importe|||50 EUR|||
|||Comisiones de gestión y otros costes|||1,20% al año.|||
|||Escenarios de rentabilidad|||
|||Comisiones de gestión|||4,9%|||
"""
PERIOD = "Período de mantenimiento recomendado: {} años\n"


def plan(spark, text):
    d = spark.createDataFrame([(1, text), (2, None), (3, "")], "id long, t string")
    return sorted(tuple(r) for r in C.schedule(d, "id", "t").collect())


def test_recommended_period_is_resolved_and_equal_horizons_merge(spark):
    assert plan(spark, PERIOD.format(5) + BLACK) == [(1, 1.0, 10.0, 0.1, False), (1, 5.0, 1100.0, 1.82, True)]
    assert plan(spark, PERIOD.format(1) + BLACK) == [(1, 1.0, 10.0, 0.1, True)]
    assert plan(spark, BLACK) == [(1, 1.0, 10.0, 0.1, False)]
    assert plan(spark, "no table") == []


def test_one_horizon_in_a_label_of_its_own(spark):
    text = "|||Costes a lo largo del tiempo|||\n|||Inversión: 10.000 EUR|||salida después del período de mantenimiento recomendado (1 año)|||\n|||Costes totales|||12 EUR|||\n|||Incidencia anual de los costes (*)|||0,12%|||"
    assert plan(spark, text) == [(1, 1.0, 12.0, 0.12, True)]


def test_header_is_carried_down_and_labels_and_values_are_put_together(spark):
    text = "|||Costs over time|||\n||||||If you exit after RHP|||If you exit|||\n||||||[5 years]|||after 1 year|||\n|||Total|||costs|||84|||20|||\n|||Annual cost im|||pact|||1,3|||%|||0.8%|||"
    assert plan(spark, PERIOD.format(5) + text) == [(1, 1.0, 20.0, 0.8, False), (1, 5.0, 84.0, 1.3, True)]


def test_more_values_than_horizons_are_of_the_recommended_period(spark):
    text = "|||Costs over time|||\n|||x|||after 1 year|||\n|||Total costs|||10|||50|||\n|||Annual cost impact|||1%|||2%|||"
    assert plan(spark, PERIOD.format(3) + text) == [(1, 1.0, 10.0, 1.0, False), (1, 3.0, 50.0, 2.0, True)]


def test_composition_reads_its_section_only(spark):
    d = spark.createDataFrame([(1, BLACK), (2, None)], "id long, t string")
    rows = C.composition(d, "id", "t").select("id", "entry_fee_pct", "entry_fee_max_pct", "entry_fee_eur", "management_fee_pct").collect()
    assert [tuple(r) for r in rows] == [(1, 3.5, 3.5, 50.0, 1.2)]


def test_records_of_both_formats(spark):
    old = "Datos fundamentales para el inversor. Gastos corrientes: 0,85 %"
    d = spark.createDataFrame([(1, PERIOD.format(5) + BLACK), (2, old), (3, "Key investor information. Entry charge 1%, exit charge 0%, ongoing charge none"), (4, ""), (5, None)], "id long, t string")
    rows = {r["id"]: r for r in C.records(d, "id", "t").collect()}
    assert [rows[i]["format"] for i in range(1, 6)] == ["PRIIPS_KID", "UCITS_KIID", "UCITS_KIID", "UNKNOWN", "UNKNOWN"]
    assert [rows[i]["quality"] for i in range(1, 6)] == ["MEDIUM", "HIGH", "LOW", "NONE", "NONE"]
    assert (rows[1]["currency"], rows[1]["horizons"], rows[1]["impact"]) == ("EUR", 2, 1.82)
    assert (rows[2]["ongoing"], rows[2]["impact"], rows[2]["horizons"]) == (0.85, 0.85, 1)


@pytest.mark.parametrize(
    ("language", "text", "day"),
    [
        ("ES", "Este documento se publicó el 27/02/2025 en Madrid", dt.date(2025, 2, 27)),
        ("ES", "Publicado a 15 de setiembre de 2022", dt.date(2022, 9, 15)),
        ("EN", "Founded 01/01/1990. Prices of 02/02/2001, published on 15 March 2022; then 3 May 2023. Updated long ago", dt.date(2022, 3, 15)),
        ("EN", "Date of publication: 15/03/2022", dt.date(2022, 3, 15)),
        ("FR", "mise à jour du 1er août 2021", dt.date(2021, 8, 1)),
        ("EN", "published on 31/02/2022, that is 01/03/2022", dt.date(2022, 3, 1)),
        ("EN", "published. 15/03/2022", None),
        ("DE", "published on 15 March 2022", None),
        ("EN", "", None),
        ("EN", None, None),
    ],
)
def test_nearest_date(spark, language, text, day):
    assert value(spark, E.published_date(F.col("t"), F.lit(language)), text) == day


def test_nearest_against_all_pairs(spark):
    import random

    rng = random.Random(5)
    texts = ["".join(rng.choice(["k", "7", "3", "x", "xx", ". "]) for _ in range(rng.randrange(0, 40))) for _ in range(300)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string")
    got = {r["id"]: r["v"] for r in df.select("id", E.nearest(F.col("t"), "k", "[0-9]", lambda t: t, kind="string", reach=6).alias("v")).collect()}
    for i, t in enumerate(texts):
        pairs = []
        for a, k in enumerate(t):
            for b, v in enumerate(t):
                low, high = min(a, b), max(a, b)
                if k == "k" and v.isdigit() and ". " not in t[low:high] and high - low - 1 <= 6:
                    pairs.append((high - low - 1, int(b < a), b, v))
        assert (tuple(got[i]) if got[i] else None) == (min(pairs) if pairs else None), t


@pytest.mark.parametrize(
    ("text", "fee"),
    [
        ("Costes de entrada: hasta el 3,50 % del importe", (3.5, "CEILING")),
        ("there is no entry fee", (0.0, "ZERO")),
        ("Sin cargo inicial, 4% de gestión", (0.0, "ZERO")),
        ("Exit 1%; front-end load of 2.5%", (2.5, "TEXT")),
        ("frais d'entrée 45 %", (None, "OUT_OF_RANGE")),
        ("nothing", (None, "NOT_FOUND")),
        (None, (None, "NOT_FOUND")),
    ],
)
def test_entry_fee(spark, text, fee):
    assert tuple(value(spark, E.entry_fee(F.col("t")), text)) == fee


@pytest.mark.parametrize(
    ("text", "found"),
    [
        ("Hemos clasificado este producto en la clase de riesgo 4 en una escala de 7", (4, "L0_FUSED")),
        ("We have classified this product as 3 out of 7. Risk class 5 on a scale", (None, "L0_CONFLICT")),
        ("nivel de riesgo: 2, categoría 6 de 7", (2, "L0")),
        ("summary risk indicator is 5. Page 1 of 3", (5, "L1")),
        ("Risk class 5 and risk category 4", (None, "L1_CONFLICT")),
        ("the SRRI of 2021, or 3%, is 6 here", (6, "L2")),
        ("clasederiesgo4enunaescala clasederiesgo5enunaescala", (None, None)),
        ("", (None, None)),
        (None, (None, None)),
    ],
)
def test_risk_votes(spark, text, found):
    assert tuple(value(spark, E.risk_class(F.col("t")), text)) == found


@pytest.mark.parametrize(
    ("drawn", "told", "level", "grade"),
    [(None, None, None, "NONE"), (4, 4, "L0", "HIGH"), (1, 4, "L0", "MEDIUM_TEXT"), (1, 4, "L1", "LOW_CONFLICT"), (3, 4, "L0", "LOW_CONFLICT"), (3, None, None, "MEDIUM_VISUAL"), (None, 3, "L2", "MEDIUM_TEXT")],
)
def test_risk_grades(spark, drawn, told, level, grade):
    assert value(spark, E.risk_grade(F.lit(drawn).cast("int"), F.lit(told).cast("int"), F.lit(level).cast("string")))["quality"] == grade
