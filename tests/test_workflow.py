"""From raw files to the integrated table."""

import json

from streetloom.dimensions import STARTER_TAXONOMY, taxonomy_frame
from streetloom.fixed_values import REQUEST_COLUMNS
from streetloom.operators.sentiment import with_sentiment
from streetloom.plans import workflow
from streetloom.session import scratch_path


def test_workflow(spark, tmp_path):
    businesses = [
        {"business_id": "a", "name": "Joe", "address": "1 Main St", "postal_code": "19104", "latitude": 40.0, "longitude": -75.1,
         "stars": 4.5, "review_count": 9, "is_open": 1, "categories": "Restaurants, Bars", "hours": {"Mon": "9-5"}},
        {"business_id": "a", "name": "Joe", "address": "1 Main St", "postal_code": "19104", "latitude": 40.0, "longitude": -75.1,
         "stars": 4.5, "review_count": 9, "is_open": 1, "categories": "Restaurants, Bars", "hours": {"Mon": "9-5"}},
        {"business_id": "b", "name": "Far", "postal_code": "08101", "latitude": 40.0, "longitude": -75.1},
        {"business_id": "c", "name": "Ann", "postal_code": "19107-11", "latitude": 40.001, "longitude": -75.1, "review_count": 1},
    ]
    reviews = [
        {"review_id": "1", "business_id": "a", "stars": 5, "text": "Very good!", "date": "2024-01-01", "useful": 1},
        {"review_id": "2", "business_id": "a", "stars": 5, "text": "Very good!", "date": "2024-01-02", "useful": 1},
        {"review_id": "3", "business_id": "b", "stars": 1, "text": "bad", "date": "2024-01-02", "useful": 1},
    ]
    for name, records in (("businesses", businesses), ("reviews", reviews)):
        (tmp_path / f"{name}.json").write_text("\n".join(map(json.dumps, records)))
    folder = tmp_path / "requests"
    folder.mkdir()
    request = dict.fromkeys(REQUEST_COLUMNS, "") | {
        "objectid": "1", "service_request_id": "7", "subject": "S", "service_name": "Sanitation  Violation",
        "requested_datetime": "2024-03-01 10:00:00", "zipcode": "19104.0", "lat": "40.0", "lon": "-75.1",
    }
    (folder / "r.csv").write_text(",".join(REQUEST_COLUMNS) + "\n" + ",".join(request[c] for c in REQUEST_COLUMNS) + "\n")

    shops = workflow.store_businesses(spark, str(tmp_path / "businesses.json"), scratch_path(spark, "b"), STARTER_TAXONOMY)
    assert [(r.business_id, r.primary_category) for r in shops.orderBy("business_id").collect()] == [
        ("a", "Food & Restaurants"), ("c", "Uncategorized"),
    ]
    table = taxonomy_frame(spark, {"First": ("rest",), "Second": ("cafe", "restaurants")})
    for match, groups in (("substring", ["First", "Second"]), ("word", ["Second"])):
        named = workflow.store_businesses(spark, str(tmp_path / "businesses.json"), scratch_path(spark, "b"), table, match=match)
        assert named.where("business_id = 'a'").first().categories_normalized[: len(groups)] == groups
    cleaned = workflow.store_reviews(spark, str(tmp_path / "reviews.json"), shops, scratch_path(spark, "r"))
    assert [r.review_id for r in cleaned.collect()] == ["1"]
    sentiment = workflow.store_sentiment(cleaned, scratch_path(spark, "s"))
    requests = workflow.store_requests(spark, str(folder), scratch_path(spark, "q"))
    targets = scratch_path(spark, "pairs"), scratch_path(spark, "closest")
    pairs, closest = workflow.store_matches(requests, shops, *targets)
    ranked = pairs.orderBy("match_rank").collect()
    assert [(r.business_id, r.hybrid_score, r.zipcode_request) for r in ranked] == [("a", 0.9, "19104"), ("c", 0.2776, "19104")]
    assert [r.business_id for r in closest.collect()] == ["a"]
    assert with_sentiment(pairs, sentiment).where("avg_sentiment > 0.4").count() == 1
    narrow, _ = workflow.store_matches(requests, shops, *targets, radius_m=50)
    assert narrow.count() == 1 and spark.read.parquet(targets[0]).count() == 3
