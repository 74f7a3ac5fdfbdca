from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from bankmart import schemas as S
from bankmart.operators import clean, rollup
from bankmart.plans import marts
from bankmart.sources import RawTables
from tests.frames import loans, rows, text


def customer(spark, **values):
    base = {"id_cliente": "c", "saldo_total_deuda": "100", "saldo_mora_total": "0", "tasa_mora_cliente_pct": "0",
            "score_crediticio": "700", "max_dias_atraso": "0", "tiene_credito_en_mora": "0", **values}
    names = S.RAW_COLUMNS["customers"]
    return spark.createDataFrame([tuple(base.get(c) for c in names)], ", ".join(f"{c} string" for c in names))


@pytest.mark.parametrize("change, kept", [
    ({}, 1), ({"fecha_vencimiento": "2023-01-15"}, 0), ({"fecha_vencimiento": "x"}, 0),
    ({"flag_error": "EXCLUIR_PROCESO_JUDICIAL"}, 0), ({"flag_error": "REVISADO"}, 1),
    ({"tasa_nominal_anual_pct": "0"}, 0), ({"tasa_nominal_anual_pct": "30"}, 1), ({"tasa_nominal_anual_pct": "30.0001"}, 0),
    ({"score_crediticio": "199"}, 0), ({"score_crediticio": "850"}, 1), ({"score_crediticio": "9999"}, 0),
    ({"saldo_capital": "-0.01"}, 0), ({"saldo_capital": "0"}, 1), ({"saldo_capital": "abc"}, 0),
])
def test_loan_exclusions(spark, change, kept):
    assert marts.mart_credits(loans(spark, change)).count() == kept


def test_bad_cells_become_null_and_are_listed(spark):
    panel = loans(spark, {"id_credito": "1", "monto_aprobado": "N/A", "dias_atraso": "-3"})
    row = marts.mart_credits(panel).first()
    assert row["monto_aprobado"] is None and row["dias_atraso"] == 0
    assert row["sector_economico"] == "No Definido" and len(row) == 52
    assert rows(clean.cast_rejects(panel, S.LOAN_TYPES, ["id_credito"])) == [("1", "monto_aprobado", "N/A")]


def test_income_sign_default_and_repair(spark):
    names = S.RAW_COLUMNS["income"]
    values = {"fecha_mes": "2024-01-31", "resultado_antes_impuestos": "-100", "impuesto_renta_25pct": "0",
              "total_ingresos": "50", "total_gastos_financieros": "20", "gasto_provisiones_periodo": "-5"}
    raw = spark.createDataFrame([tuple(values.get(c) for c in names)], ", ".join(f"{c} string" for c in names))
    as_coded = marts.mart_income(raw).first()
    assert as_coded["resultado_antes_impuestos"] == 100 and as_coded["utilidad_neta"] == 100
    assert as_coded["margen_financiero_bruto"] == 30 and as_coded["margen_financiero_neto"] == 25
    kept = marts.mart_income(raw, keep_sign=True).first()
    assert kept["utilidad_neta"] == -100 and kept["participacion_trabajadores_15pct"] == 0


def test_channel_default_tests_null_only(spark):
    df = text(spark, "canal_pago", (None,), ("",), (None,), ("web",)).withColumn("monto_pagado", F.lit(5))
    assert [r[0] for r in rows(clean.impute_channel(df))] == ["No Identificado", "", "No Identificado", "web"]


def test_instalment_from_latest_cutoff(spark):
    panel = loans(spark, {"id_credito": "1", "cuota_mensual": "10", "fecha_corte": "2023-12-31"},
                  {"id_credito": "1", "cuota_mensual": "12"}, {"id_credito": "2", "cuota_mensual": None})
    paid = spark.createDataFrame([("1", 10), ("2", 7), ("3", 8), (None, 9), ("1", None)], "id_credito string, c int").select(
        "id_credito", F.col("c").cast("decimal(18,2)").alias("cuota_pactada"))
    got = rows(clean.impute_instalment(paid, panel).orderBy("id_credito", "cuota_pactada"))
    assert [(k, v and int(v)) for k, v in got] == [(None, 9), ("1", None), ("1", 12), ("2", 7), ("3", 8)]


def test_rollup_is_independent_of_row_order(spark):
    data = [{"id_cliente": "c", "id_credito": str(i), "ingresos_anuales": str(i * 10)} for i in range(1, 9)]
    forward, backward = loans(spark, *data), loans(spark, *data[::-1]).repartition(4)
    for panel in (forward, backward):
        assert rows(rollup.first_income(panel)) == [("c", Decimal("10.00"))]
        assert rows(rollup.recent_income(panel)) == [("c", Decimal("80.00"))]


def test_rollup_takes_last_cutoff_and_tenure(spark):
    panel = loans(
        spark, {"id_cliente": "c", "id_credito": "1", "fecha_corte": "2022-01-31", "provision_constituida": "1",
                "ingresos_anuales": "11", "oficial_credito": "B"},
        {"id_cliente": "c", "id_credito": "1", "provision_constituida": "2", "saldo_capital": "100", "oficial_credito": "A",
         "tasa_nominal_anual_pct": "10"},
        {"id_cliente": "c", "id_credito": "2", "provision_constituida": "3", "saldo_capital": "300", "tasa_nominal_anual_pct": "20"})
    got = rollup.latest_rollup(rollup.loan_rollup(panel)).first()
    assert (got["provisions"], got["n_loans"], got["tenure_months"]) == (5, 2, 24)
    assert got["weighted_rate"] == Decimal("17.5") and got["loan_officer"] == "B" and got["first_income"] == 11


def test_weights_that_cancel_give_null(spark):
    panel = loans(spark, {"id_cliente": "c", "saldo_capital": "0"})
    assert rollup.loan_rollup(panel).first()["weighted_rate"] is None


def test_arrears_fix_runs_before_imputation(spark):
    raw = customer(spark, max_dias_atraso="50", tiene_credito_en_mora="1")
    panel = loans(spark, {"id_cliente": "x"})
    fixed = marts.mart_customers(raw, panel).first()
    assert fixed["calificacion_consolidada"] == "Normal" and fixed["tiene_credito_en_mora"] is False
    assert marts.mart_customers(raw, panel, fix_arrears=False).first()["calificacion_consolidada"] == "Dudoso"
    assert clean.fix_arrears_without_balance(raw).first()["flag_error"] == "MORA_SIN_SALDO"


@pytest.mark.parametrize("change, kept", [
    ({}, 1), ({"saldo_total_deuda": "-251958.69"}, 0), ({"tasa_mora_cliente_pct": "100.01"}, 0),
    ({"score_crediticio": "851"}, 0), ({"saldo_total_deuda": None}, 0),
])
def test_customer_exclusions(spark, change, kept):
    assert marts.mart_customers(customer(spark, **change), loans(spark, {"id_cliente": "x"})).count() == kept


def test_excluded_debts_are_configuration(spark):
    raw = customer(spark, saldo_total_deuda="-251958.69")
    assert marts.mart_customers(raw, loans(spark, {"id_cliente": "x"}), debts=[]).first()["saldo_total_deuda"] == Decimal("251958.69")


def test_customer_figures_come_from_loans(spark):
    raw = customer(spark, provision_total_cliente="1", ingresos_anuales="5", tipo_persona="Natural", edad_empresa_anos="9")
    panel = loans(spark, {"id_cliente": "c", "id_credito": "1", "provision_constituida": "7", "ingresos_anuales": "200",
                          "saldo_total_exposicion": "50", "oficial_credito": "OF"})
    got = marts.mart_customers(raw, panel).first()
    assert got["provision_total_cliente"] == 7 and got["ingresos_anuales"] == 200
    assert got["tasa_endeudamiento_sistema_pct"] == 25.0 and got["oficial_credito"] == "OF"
    assert got["edad_empresa_anos"] == 0 and got["es_cliente_preferente"] == 0


def test_portfolio_source_can_be_the_cleaned_loans(spark):
    names = S.RAW_COLUMNS["balance"]
    raw = spark.createDataFrame([tuple("2024-01-31" if c == "fecha_mes" else "1" for c in names)],
                                ", ".join(f"{c} string" for c in names))
    panel = loans(spark, {"id_credito": "1", "saldo_capital": "100"}, {"id_credito": "2", "saldo_capital": "-40"})
    assert marts.mart_balance(raw, panel).first()["cartera_bruta"] == 60
    assert marts.mart_balance(raw, marts.mart_credits(panel)).first()["cartera_bruta"] == 100
    assert marts.mart_balance(raw, panel, rollup.loan_rollup(panel)).first()["total_activos"] == 66


def test_raw_tables_have_every_column(spark):
    assert set(RawTables.__dataclass_fields__) == set(S.RAW_COLUMNS)
    assert [len(S.RAW_COLUMNS[t]) for t in ("loans", "income", "balance", "payments", "customers")] == [53, 35, 40, 19, 27]


def test_roll_up_converts_texts_before_its_rows_are_sorted(spark):
    """No text of an amount reaches the aggregate: rows are narrow and each text is converted once."""
    panel = loans(spark, {"id_cliente": "c", "id_credito": "1"}, id_cliente="c").where(F.rand() >= 0)
    plan = rollup.loan_rollup(panel)._jdf.queryExecution().optimizedPlan().toString()
    line = next(x for x in plan.splitlines() if "Aggregate [" in x)
    assert "saldo_capital" not in line and "cast(fecha_corte" not in line and "balance" in line
    assert rollup.loan_rollup(panel).first()["balance"] == Decimal("100.00")
