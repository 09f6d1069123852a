"""Poll tables, histories and campaign tables in the build: order, versions, checks."""

import json
from pathlib import Path

import pytest

from fixtures import RULES, landing_folder, seeds_folder, write
from test_logs_and_polls import document, endpoint
from tephra.plans import derived, lakehouse
from tephra.plans.derived import Recipe
from tephra.plans.lakehouse import BuildError, Lake


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    tmp = tmp_path_factory.mktemp("derived")
    seeds = seeds_folder(tmp / "seeds")
    write(seeds, "campaign_gpu_pins.csv", 'gpu_model,gpu_type,pool,gpu_ids,source\nRTX 4090,t,A,"A,B,-z",s\n')
    lake = Lake(spark, str(landing_folder(tmp / "land")), str(tmp / "lake"), str(seeds))
    lakehouse.build_manifest(lake, RULES, ["alpha", "beta"])
    lakehouse.ingest(lake, "r1")
    lakehouse.build_typed(lake)
    lakehouse.build_gold(lake)
    return lake


def poll(lake, name, *args, **more):
    write(Path(lake.landing).parent / "in", name, document(*args, **more))


def load(lake, label):
    return derived.load_polls(lake, str(Path(lake.landing).parent / "in"), label)


def test_order_follows_from_inputs():
    names = derived.in_order(derived.RECIPES)
    assert sorted(names) == sorted(derived.RECIPES)
    for n in names:
        assert all("." in i or names.index(i) < names.index(n) for i in derived.RECIPES[n].inputs)
    assert derived.in_order(derived.RECIPES, ["endpoint_config"]) == ["poll_documents", "endpoints", "endpoint_config"]
    with pytest.raises(BuildError, match="circle"):
        derived.in_order({"a": Recipe(("b",), None), "b": Recipe(("a",), None)})
    with pytest.raises(BuildError, match="no recipe for c"):
        derived.in_order({"a": Recipe(("c",), None)})


def test_a_second_build_rewrites_nothing(lake):
    poll(lake, "p1.json", 1, [endpoint("e1"), endpoint("ep1")], [("w1", "RUNNING")])
    poll(lake, "p2.json", 2, [endpoint("e1", "img2"), endpoint("ep1")], [("w1", "EXITED")])
    assert load(lake, "r1") == 2
    done = derived.build_derived(lake)
    assert set(done) == set(derived.RECIPES) and done["polls"] == 2 and done["endpoint_history"] == 3 and done["campaign_requests"] == 4
    assert {r.event for r in lake.table("derived", "worker_events").collect()} == {"first_seen", "status_changed"}
    assert {r.verdict for r in lake.table("derived", "setting_verdict").where("endpoint_id = 'ep1'").collect()} == {"disagree"}
    assert derived.build_derived(lake) == {}


def test_only_what_depends_on_a_change_is_rebuilt(lake):
    write(Path(lake.seeds), "campaign_gpu_pins.csv", "gpu_model,gpu_type,pool,gpu_ids,source\nRTX 4090,t,A,other,s\n")
    assert list(derived.build_derived(lake)) == ["campaign_config", "campaign_config_agreement"]
    newer = {**derived.RECIPES, "jobs": Recipe(derived.RECIPES["jobs"].inputs, derived.RECIPES["jobs"].build, revision=2)}
    assert list(derived.build_derived(lake, recipes=newer)) == ["jobs"]
    poll(lake, "p3.json", 3, [endpoint("ep1")])
    assert load(lake, "r2") == 1
    assert list(derived.build_derived(lake, ["endpoint_history", "campaign_requests"])) == ["poll_documents", "endpoints", "endpoint_config", "polls", "endpoint_history"]
    gone = lake.table("derived", "endpoint_history").where("endpoint_id = 'e1' and is_deleted").collect()
    assert [r.version_no for r in gone] == [2]


def test_a_planted_violation_ends_the_build(lake):
    twice = [endpoint("e5"), endpoint("e5")]                        # one listing that names an endpoint twice
    poll(lake, "p4.json", 4, [endpoint("ep1"), *twice])
    assert load(lake, "r3") == 1
    for _ in range(2):                                              # it stays unbuilt until it is mended
        with pytest.raises(BuildError, match="endpoints: one row for each poll and endpoint"):
            derived.build_derived(lake, ["endpoint_history"])
    kept = [json.loads(r.row) for r in lake.table("checks", "violations").where("table = 'endpoints'").collect()]
    assert kept and all(r["endpoint_id"] == "e5" for r in kept)
