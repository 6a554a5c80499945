"""Query generation against hand-derived counts and a plain loop."""

import json

import pytest
from pyspark.sql import functions as F

from presslake.catalog.inputs import configs
from presslake.operators import config as C, querygen as Q
from presslake.sources.readers import read_config

#: An invented flood: two provinces, five districts and nine towns, one of them named like its district.
SAMPLE = {
    "disaster_id": "2031-lume-flood", "start_date": "03/04/2031", "end_date": "12/04/2031",
    "hazard_names": {"en": ["Lume Flood", "Lume River"]},
    "keywords": {"en": [f"term{i}" for i in range(12)]},
    "locations": {
        "Norvale": {"districts": {"Arden": ["Arden", "Pell"], "Brack": ["Quay", "Rill", "Stane"]}},
        "Oxmoor": {"districts": {"Cray": ["Tarn"], "Dunmere": ["Umber", "Vane"], "Esk": ["Wick"]}},
    },
    "newspapers": {"en": [{"name": f"Gazette {i}", "link": f"https://gazette{i}.example.org/"} for i in range(3)]},
    "country_codes": ["NO"], "specific_links": [],
}
#: Three languages with 1 to 3 hazards, few keywords and no places.
BARE = {
    "disaster_id": "2032-dry", "start_date": "05/06/2032", "end_date": "07/06/2032",
    "hazard_names": {"en": ["Drought"], "de": ["Dürre", "Hitze"], "fr": ["Sécheresse", "Chaleur", "Canicule"]},
    "keywords": {"en": ["water"], "de": ["Wasser", "Ernte"], "fr": []},
    "locations": {}, "newspapers": {},
}
STATES, DISTRICTS, CITIES = 2, 5, 9


@pytest.fixture(scope="module")
def load(spark, tmp_path_factory):
    def read(*configs):
        folder = tmp_path_factory.mktemp("configs")
        for i, c in enumerate(configs):
            (folder / f"{i}.json").write_text(json.dumps(c, ensure_ascii=False), encoding="utf-8")
        return read_config(spark, str(folder))

    return read


def test_sample(load):
    config = load(SAMPLE)
    hazards, words, papers = (len(SAMPLE[k]["en"]) for k in ("hazard_names", "keywords", "newspapers"))
    flat = [r["location"] for r in C.flatten_locations(config).orderBy("ord").collect()]
    assert len(flat) == STATES + DISTRICTS + CITIES and flat[:4] == ["Norvale", "Arden", "Arden", "Pell"]
    broad = hazards * min(10, words) * len(flat)
    targeted = hazards * min(5, words) * min(5, len(set(flat))) * papers
    queries = Q.expand_all_queries(config).orderBy("ord").collect()
    assert len(queries) in (broad + targeted, broad + hazards * min(5, words) * min(5, len(flat)) * papers)
    assert queries[0]["query"] == "Lume Flood term0 Norvale 2031"
    assert queries[broad]["query"].startswith("Lume Flood term0 Norvale Gazette 0")
    assert [q["ord"] for q in queries] == list(range(len(queries)))
    first = [r["location"] for r in C.priority_locations(config).orderBy("ord").collect()]
    assert len(first) == len(set(flat)) and set(first[-STATES:]) == {"Norvale", "Oxmoor"}
    smart = [r["query"] for r in Q.smart_queries(config, 40).orderBy("ord").collect()]
    ranked = config.select(C.ranked_locations().alias("p")).first()["p"]
    assert smart == [t for _, t in loop(SAMPLE["hazard_names"]["en"], SAMPLE["keywords"]["en"], ranked, 40)]
    assert C.location_hierarchy(config).count() == CITIES


def test_languages_without_places(load):
    got = {}
    for r in Q.smart_queries(load(BARE), 20).orderBy("lang_code", "ord").collect():
        got.setdefault(r["lang_code"], []).append((r["type"], r["query"]))
    assert got == {k: loop(BARE["hazard_names"][k], BARE["keywords"][k], [], 20) for k in BARE["hazard_names"]}


def loop(hazards, keywords, locations, q):
    """The budget rule as a plain loop: each limit is tested after an append."""
    out = []

    def emit(kind, texts, stop):
        for t in texts:
            out.append((kind, t))
            if len(out) >= stop:
                return

    fifth, quarter = q // 5, q // 4
    emit("hazard_only", hazards, fifth)
    kws, locs = keywords[:5], (locations[:5] if locations else [""])
    room = quarter - len(out)
    emit("broad_priority", [f"{h} {k}" for h in hazards for k in kws[:room]], fifth + quarter)
    emit("location_only", [f"{h} {l}" for h in hazards for l in locs[:fifth] if l], 2 * fifth + quarter)
    base = len(out)
    emit("location_priority", [f"{h} {k} {l}" for h in hazards for k in kws[:2] for l in locs[:3] if l], base + q * 35 // 100)
    return out[:q]


def test_budget_rule(spark, load):
    shapes = [(h, k, l) for h in (0, 1, 2, 7, 13) for k in (0, 1, 3, 6) for l in (0, 1, 4)]
    configs = [
        {
            "disaster_id": f"{h}-{k}-{l}", "start_date": "01/01/2025", "end_date": "02/01/2025",
            "hazard_names": {"en": [f"h{i}" for i in range(h)]}, "keywords": {"en": [f"k{i}" for i in range(k)]},
            "locations": {"S": {"districts": {"D": [f"c{i}" for i in range(l - 1)]}}} if l else {},
        }
        for h, k, l in shapes
    ]
    table = load(*configs)
    places = {r["disaster_id"]: r["p"] for r in table.select("disaster_id", C.ranked_locations().alias("p")).collect()}
    for q in (1, 2, 3, 4, 5, 9, 20, 50):
        got = {}
        for r in Q.smart_queries(table, q).orderBy("ord").collect():
            got.setdefault(r["disaster_id"], []).append((r["type"], r["query"]))
        for h, k, l in shapes:
            name = f"{h}-{k}-{l}"
            expected = loop([f"h{i}" for i in range(h)], [f"k{i}" for i in range(k)], places[name], q)
            assert got.get(name, []) == expected, (name, q)


def test_validate(load):
    broken = {"disaster_id": "", "hazard_names": {}, "end_date": "01/01/2025"}
    late = {**SAMPLE, "disaster_id": "late", "end_date": "01/04/2031"}
    rows = C.validate_config(load(broken, late, SAMPLE)).collect()
    assert sorted((r["disaster_id"], r["error"]) for r in rows) == sorted(
        [("", C.ERRORS["id"]), ("", C.ERRORS["hazards"]), ("", C.ERRORS["start"]), ("late", C.ERRORS["order"])]
    )


def test_no_shuffle(load):
    config = load(SAMPLE)
    for frame in (Q.expand_all_queries(config), Q.smart_queries(config), C.priority_locations(config)):
        assert "Exchange" not in frame._jdf.queryExecution().executedPlan().toString()


def test_configurations_of_a_small_file_reach_all_tasks(spark, sf_dir, tmp_path):
    """One file of one row group is read by one task; its queries are made by all."""
    for name in ("nation", "region"):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    customers = spark.range(4000).selectExpr("id AS c_custkey", "concat('Customer#', id) AS c_name", "id % 25 AS c_nationkey", "'BUILDING' AS c_mktsegment")
    customers.coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    rows = Q.smart_queries(configs(spark, str(tmp_path)))
    per_task = rows.groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in per_task) < sum(r["count"] for r in per_task) / 16
