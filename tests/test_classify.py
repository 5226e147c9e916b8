from pyspark.sql import functions as F

from fundscape.operators import classify as C


def values(spark, column, rows, schema):
    return [r["v"] for r in spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "k int, " + schema).select("k", column.alias("v")).orderBy("k").collect()]


def test_cascade_takes_the_first_layer_that_is_not_vetoed(spark):
    layers = [C.Layer(n, F.col(n), F.concat(F.lit("from "), F.col(n))) for n in "abcde"]
    guards = [
        C.Guard("no_x", F.col("flag") == 1, ["x"], ["a", "b"]),
        C.Guard("no_c", F.col("flag") == 2, None, ["c"]),
        C.Guard("z_to_w", F.col("flag") >= 1, ["z"], to=F.lit("w")),
        C.Guard("w_to_v", F.col("flag") == 3, ["w"], ["e"], to=F.lit("v")),
        C.Guard("none_to_u", F.col("flag") == 4, [None], to=F.lit("u")),
    ]
    rows = [
        ("x", "y", None, None, None, 0), ("x", "y", None, None, None, 1), ("x", "x", "x", None, None, 1), (None, None, "y", "z", None, 2), (None, None, None, None, "z", 3),
        ("z", None, None, None, None, 3), (None,) * 5 + (4,), (None,) * 5 + (0,), ("x", None, None, None, None, 1), ("q", None, None, None, None, None),
    ]
    got = [tuple(v) for v in values(spark, C.cascade(layers, guards), rows, "a string, b string, c string, d string, e string, flag int")]
    assert got == [
        ("x", "a", "from x", []), ("y", "b", "from y", ["no_x"]), ("x", "c", "from x", ["no_x", "no_x"]), ("w", "d", "from z", ["no_c", "z_to_w"]), ("v", "e", "from z", ["z_to_w", "w_to_v"]),
        ("w", "a", "from z", ["z_to_w"]), ("u", None, None, ["none_to_u"]), (None, None, None, []), (None, None, None, ["no_x"]), ("q", "a", "from q", []),
    ]
    assert [tuple(v) for v in values(spark, C.cascade(layers[:1]), rows[:1], "a string, b string, c string, d string, e string, flag int")] == [("x", "a", "from x", [])]


def test_natures_and_each_guard(spark):
    cases = [
        # name, text, class of the benchmark, risk: value, layer, source, guards
        (("Plain", "A money market fund of short maturity", None, 1), (C.MONEY, "text", "money", [])),
        (("Global Equity", "A money market fund under UCITS", None, None), (C.SHARES, "name", None, ["other_than_money"])),
        (("Liquidity", "nothing", None, 6), (C.SHARES, "name", None, ["high_risk"])),
        (("Plain", "It invests mainly in bonds linked to inflation, short term", None, 2), (C.BONDS, "text", "main_bonds", ["linked_bonds"])),
        (("Plain short duration", "It invests mainly in bonds", None, 2), (C.SHORT_BONDS, "text", "main_bonds", ["short_bonds"])),
        (("Plain", "deuda soberana", None, None), (C.BONDS, "text", "main_bonds", ["flexible_bonds"])),
        (("Euro Allocation", "Mainly in bonds, and common shares", None, None), (C.MIXED, "name", None, [])),
        (("Plain", "Invierte en acciones y en renta fija", None, None), (C.MIXED, "text", "both", [])),
        (("Plain", "absolute return over the sofr", None, None), (C.OTHER, "text", "absolute", [])),
        (("Plain", "absolute return", "Commodity", 3), (C.OTHER, "benchmark", "Commodity", [])),
        (("Plain", None, "Rate", 5), (C.SHARES, "benchmark", "Rate", ["high_risk"])),
        (("Plain", "", None, 5), (C.SHARES, "risk", "5", [])),
        (("Plain", "", None, 2), (C.BONDS, "risk", "2", ["flexible_bonds"])),
        ((None, None, None, None), (C.REST, None, None, ["nothing_known"])),
        (("Equity", "a capital protected note in equity securities", None, 7), (C.STRUCTURED, "text", "structured", [])),
        (("Plain", "x" * 5000 + " money market fund", None, 4), (C.REST, None, None, ["nothing_known"])),
        (("Plain", "a 50 (autocall)" + " long" * 50_000, None, 4), (C.STRUCTURED, "text", "structured", [])),
    ]
    column = C.fund_nature(F.col("name"), F.col("text"), F.col("class"), F.col("risk"))
    got = values(spark, column, [c[0] for c in cases], "name string, text string, class string, risk int")
    assert [tuple(v) for v in got] == [c[1] for c in cases]


def test_benchmarks_inside_running_text(spark):
    cases = [
        ("El fondo crece. Índice de referencia: MSCI World Index (Net Return), un índice que no mide nada.", ("msci world index (net return)", "LABEL", False)),
        ("Objetivo\nÍndice de referencia\nBloomberg Global Aggregate TR\nRiesgos", ("bloomberg global aggregate tr", "LABEL", False)),
        ("We follow nobody. Benchmark: the Euro Stoxx 50 index; costs 1%", ("euro stoxx 50 index", "LABEL", False)),
        ("El objetivo es superar el índice MSCI Europe Index en tres años", ("msci europe index", "ACTION", False)),
        ("The fund aims to outperform the FTSE 100 Total Return over five years", ("ftse 100 total return", "ACTION", False)),
        ("En 2020 el MSCI Japan (NR) cayó", ("msci japan (nr)", "NAME", False)),
        ("Índice de referencia: €STR (en EUR)", ("€STR", "RATE", False)),
        ("Se puede utilizar el SOFR para comparar", ("SOFR", "RATE", False)),
        ("El fondo no tiene ningún valor de referencia, sino el MSCI World Index", (None, "NONE", True)),
        ("Gestionado activamente sin índice: MSCI World Index", (None, "NONE", True)),
        ("Benchmark: JPMorgan Asset Management (Europe)", (None, None, False)),
        ("Benchmark: our own choice of values", (None, None, False)),
        ("superar la inflación", (None, None, False)),
        ("superar la inflación. superar al S&P 500 Net Return del año", ("s&p 500 net return", "ACTION", False)),
        ("", (None, None, False)),
        (None, (None, None, False)),
    ]
    got = values(spark, C.benchmark_of(F.col("t")), [(c[0],) for c in cases], "t string")
    assert [tuple(v) for v in got] == [c[1] for c in cases]


def test_regions_by_layer_and_veto(spark):
    cases = [
        (("Liquidity", "USD", "Asia", None, None, C.MONEY), ("EEUU", "currency", "USD", ["liquid"])),
        ((None, None, "Asia", "msci world", "invierte en Asia", C.MONEY), (None, None, None, ["liquid"] * 3)),
        ((None, None, "Value", None, "invierte en Asia y Norteamérica", C.SHARES), (None, None, None, ["two_regions"])),
        ((None, None, "Value", "MSCI China 10/40", None, None), ("China", "benchmark", "MSCI China 10/40", [])),
        ((None,) * 6, (None, None, None, [])),
    ]
    columns = [F.col(x) for x in ("universe", "currency", "name", "benchmark", "text", "nature")]
    got = values(spark, C.region(*columns), [x[0] for x in cases], ", ".join(f"{x} string" for x in ("universe", "currency", "name", "benchmark", "text", "nature")))
    assert [tuple(v) for v in got] == [x[1] for x in cases]


def test_attributes_of_null_names(spark):
    d = spark.createDataFrame([(None, None, None), ("", "", C.SHARES), ("Blue Chip ESG Acc USDH", "small cap", C.MIXED)], "name string, text string, nature string")
    got = {r["name"]: r["x"] for r in d.select("name", C.characterize(F.col("name"), F.col("text"), F.col("nature")).alias("x")).collect()}
    x = got[None].__fields__
    assert [got[None][k]["value"] for k in x] == [None, None, None, "0", None] == [got[""][k]["value"] for k in x]
    assert [got["Blue Chip ESG Acc USDH"][k]["value"] for k in x] == ["Hedged", "Accumulation", None, "1", None]
    assert got["Blue Chip ESG Acc USDH"]["market_cap_focus"]["guards"] == ["not_shares", "not_shares"]


def test_empty_table(spark):
    none = spark.createDataFrame([], "name string, text string, class string, risk int")
    assert none.select(C.fund_nature(F.col("name"), F.col("text"), F.col("class"), F.col("risk")), C.benchmark_of(F.col("text"))).count() == 0
