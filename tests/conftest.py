import json
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from stratum.session import build_session, ensure_checkpoint_dir  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    wh = tempfile.mkdtemp(prefix="stratum-wh-", dir="/tmp")
    s = build_session("local[4]", 4, app_name="stratum-tests",
                      extra={"spark.sql.warehouse.dir": wh,
                             "spark.driver.extraJavaOptions": f"-Dderby.system.home={wh}"})
    ensure_checkpoint_dir(s)
    yield s


@pytest.fixture()
def tmp_root():
    return tempfile.mkdtemp(prefix="stratum-test-", dir="/tmp")


def rec(mal_id, title=None, members=20000, score=7.5, year=2015, source="Manga", type_="TV",
        status="Finished Airing", duration="24 min per ep", genres=(), licensors=(), studios=(),
        producers=(), themes=(), demographics=(), **extra):
    """A page record as the page documents carry it; link args are lists of
    (id, name) pairs, or None for a null array."""
    def arr(v):
        return None if v is None else [{"mal_id": i, "name": n, "type": "x", "url": "u"} for i, n in v]
    r = {"mal_id": mal_id, "title": title or f"T{mal_id}", "title_english": title or f"T{mal_id}",
         "type": type_, "source": source, "episodes": 12, "status": status, "duration": duration,
         "score": score, "scored_by": 100, "rank": 1, "popularity": 1, "members": members,
         "favorites": 10, "year": year, "genres": arr(genres), "licensors": arr(licensors),
         "studios": arr(studios), "producers": arr(producers), "themes": arr(themes),
         "demographics": arr(demographics), "images": {"jpg": {"image_url": "x"}}}
    r.update(extra)
    return r


def page_doc(records):
    return json.dumps({"pagination": {"has_next_page": True}, "data": records}, indent=2)


def write_batch(root, batch, pages):
    """Write ``root/batch_<batch>/page_<p>.json`` for {p: [records]}."""
    folder = os.path.join(root, f"batch_{batch}")
    os.makedirs(folder, exist_ok=True)
    for p, records in pages.items():
        with open(os.path.join(folder, f"page_{p}.json"), "w") as f:
            f.write(page_doc(records))
    return folder
