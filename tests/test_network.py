"""Connections, sources, sinks, the pipeline and the loader, on small networks."""

import json
import random

import pytest
from pyspark.sql import functions as F

from voltweave import config
from voltweave.functions import geometry as G
from voltweave.operators import connect as C
from voltweave.operators import ids, schema
from voltweave.plans import ingest, network, queries
from voltweave.sources import files, layers, sinks


def frame(spark, rows):
    """(id, layer, geometry text) -> features."""
    df = spark.createDataFrame([(i, a, b, json.dumps(g)) for i, (a, b, g) in enumerate(rows)], "ordinal long, id string, layer string, g string")
    return df.select("ordinal", "id", "layer", G.parse(F.col("g")).alias("geom"))


def point(x, y):
    return {"type": "Point", "coordinates": [x, y]}


def line(*c):
    return {"type": "LineString", "coordinates": [list(v) for v in c]}


def connected(spark, rows):
    return {r.id: r.connections for r in C.connect(frame(spark, rows)).collect()}


def test_rules():
    pairs = {(a, b) for a in config.LAYERS for b in config.mutual(a)}
    assert len(pairs) == 30 and all((b, a) in pairs for a, b in pairs)
    assert config.mutual("position_geographique") == ["reseau_bt"]
    assert config.mutual("reseau_souterrain_bt") == ["postes_electrique", "reseau_souterrain_bt", "reseau_bt", "reseau_souterrain_hta", "reseau_hta"]


def test_radius_priority_limit_and_order(spark):
    got = connected(spark, [
        ("ps", "postes_source", point(0, 0)), ("h50", "reseau_hta", line((50, 0), (500, 0))), ("h51", "reseau_hta", line((51, 0), (51, 500))),
        ("near", "reseau_bt", line((500, 1), (900, 1))), ("pe", "postes_electrique", point(500, 29)), ("pe2", "postes_electrique", point(500, -30)), ("pe3", "postes_electrique", point(500, 30.5)),
        ("pole", "position_geographique", point(51, 500)), ("under", "reseau_souterrain_bt", line((9000, 0), (9000, 1))), ("pole2", "position_geographique", point(9000, 0)),
    ])
    assert got["ps"] == ["h50"]  # 50 is inside, 51 is not
    assert got["h50"] == ["h51", "pe", "pe2"]  # at its far end substations come before the line that touches it
    assert got["pe3"] == ["near", "h50"] or got["pe3"] == ["near"]
    assert got["pole"] == [] and got["pole2"] == [] and got["under"] == []  # rules of one side only


def test_self_closed_loops_and_dedup(spark):
    got = connected(spark, [("a", "reseau_bt", line((0, 0), (10, 0), (0, 0))), ("b", "reseau_bt", line((0, 5), (5, 5))), ("lone", "reseau_bt", line((999, 999), (1200, 1200)))])
    assert got == {"a": ["b"], "b": ["a"], "lone": []}


def test_areas_holes_and_long_segments(spark):
    square = {"type": "Polygon", "coordinates": [[[0, 0], [1000, 0], [1000, 1000], [0, 1000], [0, 0]], [[400, 400], [600, 400], [600, 600], [400, 600], [400, 400]]]}
    got = connected(spark, [
        ("sq", "reseau_hta", square), ("in", "postes_source", point(200, 200)), ("hole", "postes_source", point(500, 500)), ("edge", "postes_source", point(1045, 500)),
        ("long", "reseau_souterrain_hta", line((-50000, -50000), (90000, 70000))), ("on", "postes_source", point(20000, 10000)), ("off", "postes_source", point(20000, 10100)),
    ])
    assert got["in"] == ["sq"] and got["hole"] == [] and got["edge"] == ["sq"] and got["on"] == ["long"] and got["off"] == []


def test_join_equals_brute_force(spark):
    rng, rows = random.Random(4), []
    for i in range(300):
        x, y = rng.uniform(-500, 500), rng.uniform(-500, 500)
        layer = rng.choice(list(config.LAYERS))
        n = rng.randint(2, 5)
        walk = [(x + rng.uniform(-200, 200) * (k > 0), y + rng.uniform(-200, 200) * (k > 0)) for k in range(n)]
        rows.append((f"f{i}", layer, line(*walk) if layer.startswith("reseau") else point(x, y)))

    def dist(p, g):
        c = g["coordinates"] if g["type"] == "LineString" else [g["coordinates"]]
        best = float("inf")
        for a, b in zip(c, c[1:] or c, strict=False):
            dx, dy = b[0] - a[0], b[1] - a[1]
            t = 0 if dx == dy == 0 else max(0, min(1, ((p[0] - a[0]) * dx + (p[1] - a[1]) * dy) / (dx * dx + dy * dy)))
            best = min(best, ((p[0] - a[0] - t * dx) ** 2 + (p[1] - a[1] - t * dy) ** 2) ** 0.5)
        return best

    want = {}
    for a, la, ga in rows:
        for end, p in ([("S", ga["coordinates"][0]), ("E", ga["coordinates"][-1])] if ga["type"] == "LineString" else [("P", ga["coordinates"])]):
            for b, lb, gb in rows:
                if a != b and lb in config.mutual(la) and (d := dist(p, gb)) <= config.LAYERS[la].radius:
                    want[a, end, b] = d
    for hot in (C.HOT_PROBES, 3):  # with 3, cells are split into parts
        found = C.distance_join(frame(spark, rows), hot_probes=hot)
        got = [((r.src_id, r.end, r.dst_id), r.distance) for r in found.collect()]
        assert len(got) == len(want) and dict(got) == pytest.approx(want)  # a pair meets once
        assert sorted(map(tuple, C.edges(C.top_connections(found)).collect())) == sorted(map(tuple, C.edges(C.top_connections(C.distance_join(frame(spark, rows)))).collect()))


def test_ordinals_across_buckets(spark):
    df = spark.range(1000).select((F.col("id") * 7 % 1000 * 3).alias("k"), F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("layer"))
    rows = sorted((r.layer, r.k, r.ordinal) for r in ids.with_ordinal(df, "layer", "k", bits=6).collect())
    for layer in "ab":
        assert [o for x, _, o in rows if x == layer] == list(range(1, sum(x == layer for x, *_ in rows) + 1))


CSV = 'geo_shape;code_commune;nom_commune;other\n"{shape}";01001;"A;b";x\nbad;2A004;;y\n"{shape2}";;"two\nlines";z\n'


def write_layers(folder, skip=()):
    def cell(g):
        return json.dumps(g).replace('"', '""')

    for i, (key, x) in enumerate(config.LAYERS.items()):
        if key in skip:
            continue
        lon, lat = 2.0 + i * 1e-5, 48.0
        g = [point(lon, lat), point(lon, lat + 1)] if not key.startswith("reseau") else [line((lon, lat), (lon + 0.01, lat)), line((lon, lat + 1), (lon, lat + 1.1))]
        (folder / x.csv_file).write_text(CSV.format(shape=cell(g[0]), shape2=cell(g[1])), encoding="utf-8")


def test_pipeline_end_to_end(spark, tmp_path):
    (tmp_path / "data").mkdir()
    places = config.Places(data=str(tmp_path / "data"), output=str(tmp_path / "out"), processed=str(tmp_path / "out"), database="default")
    write_layers(tmp_path / "data", skip=["reseau_bt"])
    said = []
    assert network.run(spark, places=places, log=said.append) is False  # a file is missing
    write_layers(tmp_path / "data")
    one = layers.load_layer(spark, "reseau_bt", places=places).orderBy("ordinal").collect()
    assert [(r.id, r.code_commune, r.nom_commune) for r in one] == [("reseau_bt_1", "01001", "A;b"), ("reseau_bt_2", None, "two\nlines")]
    assert len(one[0].original_coordinates) == 2 and "other" not in one[0]
    assert network.run(spark, places=places, log=said.append) is True, said
    stats = json.loads((tmp_path / "out/network_statistics.json").read_text())
    assert list(stats) == list(config.LAYERS) and stats["reseau_hta"]["feature_count"] == 2 and stats["reseau_hta"]["geometry_types"] == {"LineString": 2}
    doc = json.loads((tmp_path / "out/reseau_souterrain_hta.geojson").read_text())
    props = {f["properties"]["id"]: f["properties"] for f in doc["features"]}
    assert "reseau_hta_1" in props["reseau_souterrain_hta_1"]["connections"] or "postes_source_1" in props["reseau_souterrain_hta_1"]["connections"]
    assert len(json.loads((tmp_path / "out/combined_network.geojson").read_text())["features"]) == 14
    # A second run takes what was saved; changed inputs are computed again.
    mark = network.fingerprint(spark, "local", places)
    assert set(sinks.saved_layers(spark, str(tmp_path / "out/individual"), mark)) == set(config.LAYERS)
    assert not sinks.saved_layers(spark, str(tmp_path / "out/individual"), "other")
    assert sinks.clean_checkpoints(spark, str(tmp_path / "out/individual")) == 7 and not files.exists(spark, str(tmp_path / "out/individual"))
    # The loader reads what the pipeline wrote.
    assert files.geojson_files(spark, str(tmp_path / "out"))[0].endswith("reseau_souterrain_hta.geojson")
    result = ingest.run(spark, places)
    assert result["summary"]["success_rate"] == "1/1" and result["summary"]["total_rows_processed"] == 2, result
    t = spark.table("default.reseau_souterrain_hta")
    assert t.columns == ["feature_id", "feature_type", "geometry_json", "geometry", "code_commune", "connections", "id", "layer", "nom_commune", "original_coordinates"]
    assert dict(t.dtypes)["connections"] == "array<string>" and t.where("geometry LIKE 'LINESTRING(%'").count() == 2
    assert ingest.health(spark, places)["status"] == "healthy" and ingest.describe(spark, places)["file_count"] > 0
    spark.sql("DROP TABLE default.reseau_souterrain_hta")


def test_load_errors(spark, tmp_path):
    places = config.Places(data=str(tmp_path), processed=str(tmp_path))
    (tmp_path / "poste-source.csv").write_text("geo_shape\nbad\n")
    with pytest.raises(ValueError):
        layers.load_layer(spark, "postes_source", places=places)
    (tmp_path / "poste-source.csv").write_text("shape\nbad\n")
    with pytest.raises(KeyError):
        layers.load_layer(spark, "postes_source", places=places)
    with pytest.raises(ValueError):
        layers.load_layer(spark, "postes_source", "ftp", places=places)
    with pytest.raises(ValueError):
        sinks.save_layer(None, "x", "ftp")
    assert "message" in ingest.run(spark, places)
    for i, text in enumerate(["no json", '{"features":[]}', '{"features":[{"properties":{"a-b":1,"a b":2}}]}', '{"features":[null]}']):
        (tmp_path / f"reseau_souterrain_hta{i}.geojson").write_text(text)
    got = ingest.run(spark, places)
    assert len(got["failed_files"]) == 4 and got["summary"]["success_rate"] == "0/4"
    said = [r.message for r in spark.read.json(str(tmp_path / "error_log")).collect()]
    assert len(said) == 5 and "0 files loaded, 4 not, 0 rows" in said  # one for each file, and the batch


def test_dropped_features_and_tables_that_stay(spark, tmp_path):
    places = config.Places(processed=str(tmp_path))
    name = "reseau_souterrain_hta_drop"
    (tmp_path / f"{name}.geojson").write_text('{"features":[{"properties":{"a":1}},"text",[1],{"properties":{"a":2}}]}')
    got = ingest.run(spark, places)
    assert got["summary"]["success_rate"] == "1/1" and got["summary"]["total_rows_processed"] == 2
    said = sorted(r.message.split(": ", 1)[1] for r in spark.read.json(str(tmp_path / "error_log")).collect())
    assert said == ["dropped, no object, position 1: text", "dropped, no object, position 2: [1]"]
    with pytest.raises(Exception, match="no such row"):  # a write that fails leaves the table
        sinks.replace_table(spark.range(1).select(F.raise_error(F.lit("no such row")).cast("long").alias("b")), f"default.{name}")
    assert spark.table(f"default.{name}").count() == 2
    sinks.replace_table(spark.range(3).toDF("other"), f"default.{name}")
    assert spark.table(f"default.{name}").columns == ["other"] and not [t.name for t in spark.catalog.listTables("default") if t.name.startswith(f"{name}__")]
    spark.sql(f"DROP TABLE default.{name}")


def test_schema_inference(spark):
    f = ['{"properties":{"n":null,"b":true,"i":1,"f":1.0,"s":"x","e":[],"v":[null],"l":["a",null],"m":["a",1],"ll":[[1]],"o":{"k":1}}}', '{"properties":{"n":1,"i":2.5,"late":7}}', '{"properties":[1]}', '{"properties":null}', "{}"]
    df = spark.createDataFrame(list(enumerate(f)), "position int, feature string")
    got = {k: t for k, _, t in schema.infer_schema(df)[4:]}
    assert got == {"n": "STRING", "b": "BOOLEAN", "i": "INTEGER", "f": "FLOAT", "s": "STRING", "e": "STRING REPEATED", "v": "STRING REPEATED", "l": "STRING REPEATED", "m": "JSON", "ll": "JSON", "o": "JSON", "late": "INTEGER"}
    rows = schema.flatten(df, schema.infer_schema(df)).collect()
    assert len(rows) == 5 and rows[0].l == ["a", None] and json.loads(rows[0].o) == {"k": 1} and rows[1].late == 7


def test_regression_anchors(spark):
    sf = "/root/testdata/sf0.001"
    assert queries.layer_features(spark, sf).count() == 1860
    assert queries.topk_connections(spark, sf).count() == 1718
    assert queries.connections(spark, sf).where("dst_id IS NOT NULL").count() == 1277
    assert queries.one_way_edges(spark, sf).count() == 33


def test_pairs_are_not_shuffled_after_the_join(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        points = spark.createDataFrame([(i, f"a{i}", "reseau_bt", float(i)) for i in range(9)], "ordinal long, id string, layer string, x double")
        v = F.struct(F.col("x"), F.lit(0.0).alias("y"))
        f = points.select("ordinal", "id", "layer", F.struct(F.lit("Point").alias("type"), F.array(F.array(F.array(v))).alias("parts")).alias("geom"))
        plan = C.top_connections(C.distance_join(f))._jdf.queryExecution().executedPlan().toString()
        # Probes once for each of the two joins (the second a reuse), candidates of either kind once: none for pairs or ranks.
        exchanges = [x for x in plan.splitlines() if "Exchange" in x]
        assert all("cell" in x or "Reused" in x for x in exchanges), exchanges
        assert sum("src_id" in x for x in exchanges) == 0 and len(exchanges) <= 5, exchanges
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_top_k_is_cut_before_the_shuffle_and_the_join_is_on_cells(spark):
    plan = queries.topk_connections(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "NestedLoop" not in plan and "Cartesian" not in plan


def test_documents_of_one_feature_a_line_are_many_tasks(spark, tmp_path):
    """Their features are those of the whole document, whatever the form; before, a document was always one row of one task."""
    f = [{"id": i, "properties": {"a": "x, ]}\\" * i, "n": i}} for i in range(400)] + ["text", None, [1], 2.5]
    one = [json.dumps(x) for x in f]
    bad = one[:3] + ["{} {}"] + one[3:]
    forms = {
        "ours": '{"type":"FeatureCollection","features":[\n' + "\n,".join(one) + "\n]}",
        "tools": '{\n"type": "x",\n"crs": {"a": [1]},\n"features": [\r\n' + ",\r\n".join(one) + "\n]\n}\n",
        "more_after": '{"features":[\n' + ",\n".join(one) + '\n],"bbox":[1]}',
        "two_a_line": '{"features":[\n' + ",\n".join([", ".join(one[:2]), *one[2:]]) + "\n]}",
        "one_line": json.dumps({"features": f}),
        "indented": json.dumps({"features": f}, indent=1),
        "no_comma": '{"features":[\n' + "\n".join(one) + "\n]}",
        "garbage": '{"features":[\n' + ",\n".join(bad) + "\n]}",
        "two_heads": '{"features":[1],"features":[\n' + ",\n".join(one) + "\n]}",
        "empty": '{"features":[\n]}',
        "cut": '{"features":[\n' + ",\n".join(one),
    }
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        for name, text in forms.items():
            path = str(tmp_path / f"{name}.geojson")
            (tmp_path / f"{name}.geojson").write_bytes(text.encode())
            got = layers.read_features(spark, path)
            want = schema.explode_features(layers.read_geojson(spark, path)).select("position", "feature")
            assert got.dtypes == want.dtypes and sorted(map(repr, got.collect())) == sorted(map(repr, want.collect())), name
            if name in ("ours", "tools"):
                assert got.count() == len(f) and got.rdd.getNumPartitions() > 5, name
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_first_pairs_come_from_bounded_reaches(spark):
    """In a dense place the top-k is that of all pairs, and most pairs are never made; before, all of them were."""
    rng, rows = random.Random(7), []
    for i in range(500):
        x, y = rng.uniform(-45, 45), rng.uniform(-45, 45)
        layer = rng.choice(list(config.LAYERS))
        area = {"type": "Polygon", "coordinates": [[[x, y], [x + 3, y], [x, y + 3], [x, y]]]}
        g = line((x, y), (x + rng.uniform(-20, 20), y + rng.uniform(-20, 20))) if layer.startswith("reseau") else point(x, y)
        rows.append((f"f{i}", layer, area if i % 25 == 0 else g))
    rows += [("far", "reseau_bt", line((1e9, 0), (1e9, 9))), ("far2", "postes_electrique", point(1e9, 1)), ("lone", "reseau_hta", line((-900, -900), (-905, -905))), ("lone2", "reseau_hta", line((-915, -905), (-990, -905)))]
    f = frame(spark, rows).localCheckpoint()
    every = C.distance_join(f).localCheckpoint()
    want = sorted(map(repr, C.top_connections(every).select("src_id", "end", "rank", "dst_id", "distance").collect()))
    for more in ({}, {"tight_cells": 2}, {"hot_probes": 20}):
        some = C.nearest_pairs(f, **more).localCheckpoint()
        got = sorted(map(repr, C.top_connections(some).select("src_id", "end", "rank", "dst_id", "distance").collect()))
        assert got == want and some.count() * 2 < every.count(), (more, some.count(), every.count())


def shuffled_rows(df):
    """Rows that the plan's exchanges wrote when ``df`` was collected (without adaptive execution)."""
    plans, n = [df._jdf.queryExecution().executedPlan()], 0
    while plans:
        p = plans.pop()
        if p.nodeName() == "Exchange":
            n += p.metrics().apply("shuffleRecordsWritten").value()
        plans += [p.children().apply(i) for i in range(p.children().size())]
    return n


def unplanned(spark, f):
    """``f()`` with plain shuffles: no adaptive execution, no broadcast."""
    off = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in off}
    for k, v in off.items():
        spark.conf.set(k, v)
    try:
        return f()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_distance_join_shuffles_a_candidate_once_for_each_tile(spark):
    """Lines of 40 units lie in some dozen cells of 30, and in two or three tiles; before, each cell's copy was shuffled."""
    rng = random.Random(3)
    rows = [(f"f{i}", "reseau_bt", line((x, y), (x + 40, y + 30))) for i in range(400) for x, y in [(rng.uniform(-900, 900), rng.uniform(-900, 900))]]
    f = frame(spark, rows).localCheckpoint()

    def run():
        df = C.distance_join(f)
        return df.collect(), shuffled_rows(df)

    found, n = unplanned(spark, run)
    assert len(found) > 400 and n < 6 * len(rows), n  # two probes of each among them


def test_distance_join_of_long_lines_areas_and_shared_tiles(spark):
    square = {"type": "Polygon", "coordinates": [[[0, 0], [1000, 0], [1000, 1000], [0, 1000], [0, 0]], [[400, 400], [600, 400], [600, 600], [400, 600], [400, 400]]]}
    rows = [
        ("sq", "reseau_hta", square), ("in", "postes_source", point(200, 200)), ("hole", "postes_source", point(500, 500)), ("edge", "postes_source", point(1045, 500)), ("rim", "postes_source", point(560, 500)),
        ("long", "reseau_souterrain_hta", line((-50000, -50000), (90000, 70000))), ("on", "postes_source", point(20000, 10000)), ("off", "postes_source", point(20000, 10100)),
        ("bent", "reseau_hta", line((-5000, 0), (-4000, 0), (-4000, 900), (-5000, 900))), ("by", "postes_source", point(-3950, 450)), ("mid", "postes_source", point(-4500, 450)),
    ]
    want = {("in", "sq"): 0.0, ("edge", "sq"): 45.0, ("rim", "sq"): 40.0, ("by", "bent"): 50.0, ("on", "long"): abs(70000 * 120000 - 60000 * 140000) / (140000**2 + 120000**2) ** 0.5}
    for hot in (C.HOT_TILE_PROBES, 1):
        got = [((r.src_id, r.dst_id), r.distance) for r in C.distance_join(frame(spark, rows), hot_probes=hot).where("src_layer = 'postes_source'").collect()]
        assert len(got) == len(want) and dict(got) == pytest.approx(want, abs=1e-6)


def test_bbox_pairs_shuffle_a_candidate_once_for_each_tile(spark):
    """Equal to all pairs; before, each box was shuffled to some dozens of cells of either radius."""
    rng = random.Random(5)
    rows = [(f"f{i}", rng.choice(list(config.LAYERS)), line((x, y), (x + rng.uniform(-40, 40), y + 30))) for i in range(300) for x, y in [(rng.uniform(-700, 700), rng.uniform(-700, 700))]]
    f = frame(spark, rows).localCheckpoint()

    def run():
        df = C.bbox_pairs(f)
        return sorted(map(tuple, df.collect())), shuffled_rows(df)

    want = []
    for a, layer, g in rows:
        h = 1.5 * config.LAYERS[layer].radius
        for end, (px, py) in zip("SE", g["coordinates"], strict=True):
            for b, _, other in rows:
                (ax, ay), (bx, by) = other["coordinates"]
                if a != b and min(ax, bx) <= px + h and max(ax, bx) >= px - h and min(ay, by) <= py + h and max(ay, by) >= py - h:
                    want.append((a, end, b))
    found, n = unplanned(spark, run)
    assert found == sorted(want) and n < 7 * len(rows), n  # two probes of each among them


def test_loader_parses_features_once_for_a_table_and_once_for_its_schema(spark):
    """One pass has the counts and the types that four passes had; before, flattening parsed a feature for its filter, id, type and each column anew."""
    f = ['{"type":"x","geometry":{"type":"Point","coordinates":[1,2]},"properties":{"a":1,"b":"x","l":["y"]}}', ' {"properties":{"a":"late","c":[1,2]}}', '{"properties":[7,8]}', '{"properties":null}', "{}", "text", "[1,2]", '{"cut', "null", None, '{"properties":{"c":2.5,"d":null}}']
    df = spark.createDataFrame(list(enumerate(f)), "position int, feature string")
    n, nulls, others, found = schema.inspect(df)
    assert (n, nulls, others) == (len(f), 2, schema.not_objects(df).count()) and others == 5
    assert found == sorted(map(tuple, schema.infer_types(schema.property_values(df)).collect())) == [("a", "INTEGER"), ("b", "STRING"), ("c", "JSON"), ("d", "STRING"), ("l", "STRING REPEATED")]
    assert schema.inspect(df.where("false")) == (0, 0, 0, [])
    flat = schema.flatten(df, schema.columns(found))
    rows = sorted(flat.collect())
    assert [r.feature_id for r in rows] == sorted(f"feature_{i}" for i in (0, 1, 2, 3, 4, 10)) and rows[0].geometry == "POINT(1 2)" and rows[0].a == 1
    plan = flat._jdf.queryExecution().optimizedPlan().toString().lower()
    assert plan.count("parsejson") + plan.count("parse_json") == 1 and plan.count("$.geometry") == 1, plan


def test_distance_join_of_given_probes_and_candidates(spark, monkeypatch):
    """Pairs of one frame with another are those of both that lead from the first to the second; the join of shapes asks for no others, as it did before."""
    rng = random.Random(11)
    at = lambda: (rng.uniform(-100, 100), rng.uniform(-100, 100))
    rows = [(f"s{i}", "postes_electrique", point(*at())) for i in range(40)] + [(f"l{i}", "reseau_hta", line(at(), at(), at())) for i in range(60)]
    f = frame(spark, rows).localCheckpoint()
    stations, lines = f.where("id LIKE 's%'"), f.where("id LIKE 'l%'")
    got = sorted(map(repr, C.distance_join(stations, among=lines).drop("cell").collect()))
    assert got and got == sorted(map(repr, C.distance_join(f).where("src_id LIKE 's%' AND dst_id LIKE 'l%'").drop("cell").collect()))
    asked, join = [], C.distance_join
    monkeypatch.setattr(C, "distance_join", lambda features, *a, **k: asked.append({r.layer for r in features.select("layer").distinct().collect()}) or join(features, *a, **k))
    queries.Q["shapes_join"](spark, "/root/testdata/sf0.001").count()
    assert asked == [{"postes_electrique"}]


def test_first_pairs_are_no_more_than_the_limits_and_the_statistics_are_those_of_the_lists(spark):
    """Points, bent lines, areas, ties and lines longer than a tile; before, some multiples of the limits were made and sorted."""
    rng, rows = random.Random(21), []
    for i in range(400):
        x, y = rng.randint(200, 280), rng.randint(-20, 60)
        layer = rng.choice(list(config.LAYERS))
        if not layer.startswith("reseau"):
            g = point(x, y)
        elif i % 40 == 0:
            g = {"type": "Polygon", "coordinates": [[[x, y], [x + 5, y], [x, y + 5], [x, y]]]}
        elif i % 7 == 0:
            g = line((x, y), (x + 10, y), (x + 10, y + 9), (x, y + 9))
        else:
            g = line((x, y), (x + rng.randint(-12, 12), y + rng.randint(-12, 12)))
        rows.append((f"f{i}", layer, g))
    rows += [("long", "reseau_hta", line((-3000, 5), (2400, 30))), ("lone", "reseau_bt", line((9000, 9000), (9001, 9000)))]
    f = frame(spark, rows).localCheckpoint()
    columns = ["src_id", "end", "rank", "dst_id", "distance"]
    want = sorted(map(tuple, C.top_connections(C.distance_join(f)).select(*columns).collect()))
    for more in ({}, {"hot_probes": 20}):
        assert sorted(map(tuple, C.nearest_pairs(f, **more).select(*columns).collect())) == want, more
    lists = C.connect(f).select("layer", "id", "connections").collect()
    firsts, ends = {}, {}
    for a, end, _, b, _ in want:
        (firsts if end == "P" else ends).setdefault(a, []).append(b)
    assert {r.id: r.connections for r in lists} == {i: firsts.get(i) or sorted(set(ends.get(i, []))) for i, _, _ in rows}
    counts = {r.layer: (r.feature_count, r.total_connections) for r in C.connection_counts(f).collect()}
    assert counts == {k: (sum(r.layer == k for r in lists), sum(len(r.connections) for r in lists if r.layer == k)) for k in config.LAYERS}
    codes = {i: n for n, (i, _, _) in enumerate(rows)}
    pairs = {(codes[a], codes[b]) for a, _, _, b, _ in want}
    assert {(r.src_ordinal, r.dst_ordinal) for r in C.one_way(C.nearest_pairs(f)).collect()} == {(a, b) for a, b in pairs if (b, a) not in pairs}
