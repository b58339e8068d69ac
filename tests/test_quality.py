import pytest

from terrapipe.operators import quality as Q
from terrapipe.schemas import MUNICIPALITY_RAW, STATE_RAW, UF_CODES


def _town(key, code="BA", name="Vila Nova"):
    inside = {"id": 5, "nome": "vale", "UF": {"id": 6, "sigla": code, "nome": "estado"}}
    return {"id": key, "nome": name, "microrregiao": {"id": 4, "nome": "serra", "mesorregiao": inside}}


@pytest.mark.parametrize("rows,bad", [
    ([_town(10), _town(11, "CE"), _town(12, "PI", " ")], None),
    ([], "non_empty"),
    ([_town(10), {"id": 11, "nome": "sem cadeia"}], "1/2"),
    ([_town(10), _town(11, ""), _town(0), _town(12, "BA", None)], "3/4"),
])
def test_raw_municipality_gate(spark, rows, bad):
    df = spark.createDataFrame(rows, MUNICIPALITY_RAW)
    if bad is None:
        assert Q.gate_raw_municipalities(df) == len(rows)
    else:
        with pytest.raises(Q.DataQualityError, match=bad):
            Q.gate_raw_municipalities(df)


def test_raw_state_gate_needs_every_field(spark):
    whole = {"id": 8, "sigla": "GO", "nome": "Campos"}
    assert Q.gate_raw_states(spark.createDataFrame([whole], STATE_RAW)) == 1
    for field in whole:
        with pytest.raises(Q.DataQualityError, match="truthy"):
            Q.gate_raw_states(spark.createDataFrame([{k: v for k, v in whole.items() if k != field}], STATE_RAW))


def test_truthy_counts_null_zero_empty_and_passes_blank(spark):
    rows = [
        {"id": 1, "sigla": "RJ", "nome": "ok"},
        {"id": 2, "sigla": "SP", "nome": "  "},      # blank passes gate 1
        {"id": 0, "sigla": "RJ", "nome": "zero"},
        {"id": None, "sigla": "RJ", "nome": "null id"},
        {"id": 3, "sigla": "", "nome": "empty"},
        {"id": 4, "sigla": None, "nome": None},
    ]
    report = Q.check(spark.createDataFrame(rows, STATE_RAW), list(Q.RAW_STATE_RULES)).collect()
    assert [(r.rule, r.bad_rows, r.total_rows) for r in report] == [("truthy", 4, 6)]
    assert report[0].example.startswith('{"id":')


def test_report_example_is_deterministic_and_cut_for_municipalities_only(spark):
    long_name = "x" * 500
    df = spark.createDataFrame([{"id": 9, "nome": long_name}, {"id": 8, "nome": long_name}], MUNICIPALITY_RAW)
    ex = Q.check(df, list(Q.RAW_MUNICIPALITY_RULES)).first().example
    assert len(ex) == 200 and ex.startswith('{"id":8')
    states = spark.createDataFrame([{"id": 0, "sigla": "AM", "nome": long_name}], STATE_RAW)
    whole = Q.check(states, list(Q.RAW_STATE_RULES)).first().example
    assert long_name in whole and whole.endswith("}")  # a state is shown whole


def _processed(spark, rows):
    return spark.createDataFrame(rows, "id int, nome string, sigla_uf string")


def test_contract_accepts_good_and_rejects_duplicate_and_unknown_code(spark):
    assert Q.MUNICIPALITIES_CONTRACT.enforce(_processed(spark, [(40, "Lagoa", "MA"), (41, "Lagoa", "MA")])) == 2
    with pytest.raises(Q.DataQualityError, match="unique.id.: 3/5 e.g. 40"):
        Q.MUNICIPALITIES_CONTRACT.enforce(_processed(spark, [(k, f"n{i}", "MA") for i, k in enumerate((40, 41, 40, 42, 40))]))
    with pytest.raises(Q.DataQualityError, match="isin"):
        Q.MUNICIPALITIES_CONTRACT.enforce(_processed(spark, [(40, "Lagoa", "ma")]))


def test_contract_reports_every_rule(spark):
    df = _processed(spark, [(1, "A", "XX"), (1, None, "SP"), (-5, "C", None), (None, "D", "RJ")])
    report = {(r.rule, r.column): r for r in Q.MUNICIPALITIES_CONTRACT.check(df).collect()}
    assert report[("unique", "id")].bad_rows == 2 and report[("unique", "id")].example == "1"
    assert report[("gt_0", "id")].bad_rows == 1
    assert report[("not_null", "id")].bad_rows == 1
    assert report[("not_null", "nome")].bad_rows == 1
    assert report[("isin", "sigla_uf")].bad_rows == 1       # NULL is judged by not_null only
    assert report[("not_null", "sigla_uf")].bad_rows == 1
    assert all(r.total_rows == 4 for r in report.values())


def test_column_contract_checked_without_a_job(spark):
    df = spark.createDataFrame([(1, 2)], "id int, nome int")
    with pytest.raises(Q.DataQualityError, match="nome is int, expected str"):
        Q.MUNICIPALITIES_CONTRACT.check(df)
    assert [tuple(r) for r in Q.MUNICIPALITIES_CONTRACT.column_report(df).collect()] == [("nome", "str", "int"), ("sigla_uf", "str", None)]
    # extra columns are allowed, any integral type is accepted for "int"
    ok = spark.createDataFrame([(1, "a", "SP", 9)], "id bigint, nome string, sigla_uf string, extra int")
    assert Q.MUNICIPALITIES_CONTRACT.enforce(ok) == 1


def test_length_and_max_length(spark):
    df = spark.createDataFrame([("RJ",), ("R",), ("RJX",), (None,)], "sigla string")
    r = Q.check(df, [Q.length_between("sigla", 2, 2), Q.max_length("sigla", 2)]).collect()
    assert [(x.rule, x.bad_rows) for x in r] == [("length_2_2", 2), ("max_length_2", 1)]


def test_registry(spark):
    assert Q.CONTRACTS[("territory", "states")] is Q.STATES_CONTRACT
    assert len(UF_CODES) == 27 and len(set(UF_CODES)) == 27


def _jobs(spark, group, fn):
    sc = spark.sparkContext
    sc.setJobGroup(group, group)
    try:
        fn()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    return len(sc.statusTracker().getJobIdsForGroup(group))


def test_row_rules_share_one_aggregate_job(spark, tmp):
    path = f"{tmp}/t"
    spark.createDataFrame([(i + 1, f"n{i}", "SP") for i in range(500)],
                          "id int, nome string, sigla_uf string").write.parquet(path)
    df = spark.read.parquet(path)
    one = _jobs(spark, "one-rule", lambda: Q.enforce(df, [Q.not_null("id")]))
    many = _jobs(spark, "many-rules", lambda: Q.enforce(df, [
        Q.not_null("id"), Q.positive("id"), Q.not_null("nome"), Q.max_length("nome", 200),
        Q.not_null("sigla_uf"), Q.isin("sigla_uf", UF_CODES), Q.length_between("sigla_uf", 2, 2)]))
    assert many == one
    with_unique = _jobs(spark, "with-unique", lambda: Q.enforce(df, [Q.not_null("id"), Q.unique("id")]))
    assert with_unique > one  # the exchange on the keys
    two = _jobs(spark, "two-unique", lambda: Q.enforce(df, [Q.not_null("id"), Q.unique("id"), Q.unique("nome")]))
    assert two == with_unique  # more keys, the same pass


def test_a_contract_reads_its_input_once(spark, sf_small):
    from conftest import plan_text
    from terrapipe.plans.catalog import QUERIES
    tree = plan_text(QUERIES["contract_states"](spark, sf_small)).split("\n\n")[0]
    assert tree.count("Scan parquet") == 4  # the star join's tables
    assert Q.check(spark.createDataFrame([], "id int, nome string"), [Q.unique("id"), Q.not_null("nome"), Q.non_empty()]).collect() == [
        ("not_null", "nome", 0, 0, None), ("non_empty", "*", 1, 0, None), ("unique", "id", 0, 0, None)]


def test_isin_against_a_domain_table(spark):
    df = _processed(spark, [(1, "A", "SP"), (2, "B", "XX"), (3, "C", None), (4, "D", "YY"), (5, "E", "XX")])
    domain = spark.createDataFrame([(c,) for c in UF_CODES], "sigla string")
    r = Q.check_in_table(df, "sigla_uf", domain, "sigla").first()
    assert (r.rule, r.bad_rows, r.total_rows, r.example) == ("in_table", 3, 5, "XX")


def test_gating_while_writing_refuses_uniqueness_rules(spark, tmp):
    df = _processed(spark, [(1, "A", "SP")])
    with pytest.raises(ValueError, match="grouped pass"):
        Q.enforce_while_writing(df, [Q.unique("id")], lambda d: d.write.json(f"{tmp}/never"))
    written = []
    assert Q.enforce_while_writing(df, [Q.not_null("id")], lambda d: written.append(d.write.json(f"{tmp}/ok"))) == 1
    assert spark.read.json(f"{tmp}/ok").count() == 1
