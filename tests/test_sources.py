import pytest

from martloom.sources import files as S
from martloom.sources.html import PANEL_CELLS, pages_until_empty, table_rows

CELLS = "<td> Boston Bruins </td><td>1990</td><td>44</td><td>24</td><td> </td><td>0.55</td>"
HEAD = "<tr>" + "<th>x</th>" * 9 + "</tr>"


def page(*rows, css="table"):
    return f'<p>x</p><table class="{css}">{HEAD}{"".join(rows)}</table>'


def test_missing_sources_raise(spark, tmp_path):
    for scan in (S.scan_transactions, S.scan_macro):
        with pytest.raises(S.MissingSource):
            scan(spark, str(tmp_path / "none.csv"))


def test_empty_source_raises(spark, tmp_path):
    path = tmp_path / "m.csv"
    path.write_text(",".join(S.MACRO_TYPES) + "\n")
    with pytest.raises(S.EmptySource):
        S.scan_macro(spark, str(path))


def test_macro_types_and_null_tokens(spark, tmp_path):
    path = tmp_path / "m.csv"
    path.write_text(",".join(S.MACRO_TYPES) + "\n2019-01-07,96.4,388.0,3.95,NaN\n")
    r = S.scan_macro(spark, str(path)).first()
    assert str(r["week"]) == "2019-01-07" and r["lumber_price_index"] == 388.0
    assert r["season_factor"] is None


def test_transactions_stay_text_with_origin(spark, tmp_path):
    path = tmp_path / "t.csv"
    values = ["2024-01-01", "2024", "1", "1", "Pacific", "lumber", "LUM-1", "pro_dealer"]
    values += ["homebuilder", "oops", "1.5", "3", "1", "N/A", "2"]
    path.write_text(",".join(S.TRANSACTION_TYPES) + "\n" + ",".join(values) + "\n")
    r = S.scan_transactions(spark, str(path), origin=True).first()
    assert r["units"] == "oops" and r["lumber_price_index"] is None
    assert r["source_file"].endswith("t.csv") and r["row_no"] == 0


def test_dictionary_is_optional_and_gives_a_schema(spark, tmp_path):
    assert S.scan_dictionary(spark, str(tmp_path / "none.csv")).count() == 0
    path = tmp_path / "d.csv"
    path.write_text("column,type,description\ndate,date,day\nunits,int,n\nprice,float,p\nsku,string,s\n")
    schema = S.dictionary_schema(S.scan_dictionary(spark, str(path)))
    kinds = {f.name: f.dataType.simpleString() for f in schema}
    assert kinds == {"date": "date", "units": "int", "price": "double", "sku": "string"}


def test_html_table(spark):
    full = f"<tr>{CELLS}<td>299</td><td>264</td><td>35</td></tr>"
    short = f"<tr>{CELLS}<td>299</td><td>264</td></tr>"
    marked = full.replace(" Boston Bruins ", "<a href='x'>A &amp; B</a>")
    pages = [(1, page(full, short, marked)), (2, page(full, css="other")), (3, "<p>none</p>")]
    rows = table_rows(spark.createDataFrame(pages, "page int, html string"), "html").collect()
    assert [(r["page"], r["pos"], r["team"]) for r in rows] == [
        (1, 1, "Boston Bruins"),
        (1, 3, "A & B"),
    ]
    r = rows[0]
    assert r["ot_losses"] is None and (r["year"], r["win_rate"], r["goal_diff"]) == (1990, 0.55, 35)
    assert set(PANEL_CELLS) <= set(r.asDict())


def test_pages_stop_at_first_empty_one(spark):
    counts = spark.createDataFrame([(1, 25), (2, 7), (3, 0), (4, 9)], "page int, n int")
    assert [r["page"] for r in pages_until_empty(counts, "page", "n").orderBy("page").collect()] == [1, 2]
    assert pages_until_empty(counts.filter("n > 0"), "page", "n").count() == 3
