from __future__ import annotations

import time
from collections import Counter

import pytest

import tidemark.streaming.crawl as module
from tidemark.sources.crawl import fetch_documents, read_landed
from tidemark.streaming.crawl import crawl_queue, queue_requests

SCHEMA = "url string, file_name string, n int"


def requests(spark, numbers):
    return spark.createDataFrame([(f"http://h{n % 3}/{n}", f"{n}.txt", n) for n in numbers], SCHEMA)


@pytest.fixture
def crawl(spark, tmp_path):
    """Runs the queue; every request leaves a line in a file."""
    asked = tmp_path / "asked"

    def run(**options):
        def open_client():
            def fetch(url):
                with open(asked, "a") as out:
                    out.write(url + "\n")
                if url.endswith("/13"):
                    raise OSError("gone")
                return f"body of {url}"

            return fetch

        return crawl_queue(
            spark, str(tmp_path / "queue"), SCHEMA, str(tmp_path / "checkpoint"), str(tmp_path / "landing"), open_client,
            parallelism=2, files_per_batch=1, attempts=1, **options,
        )

    run.queue = lambda numbers: queue_requests(requests(spark, numbers).coalesce(1), str(tmp_path / "queue"), per_file=5)
    run.asked = lambda: Counter(asked.read_text().split()) if asked.exists() else Counter()
    run.landed = lambda: {r["n"] for r in read_landed(spark, str(tmp_path / "landing"), SCHEMA + ", body string").collect()}
    return run


def test_a_queue_is_crawled_in_small_batches(crawl):
    assert crawl.queue(range(20)) == 20
    assert crawl() == 4
    assert crawl.landed() == set(range(20)) - {13}
    assert crawl() == 0
    crawl.queue(range(100, 103))
    assert crawl() == 1 and crawl.landed() == set(range(20)) - {13} | {100, 101, 102}
    assert set(crawl.asked().values()) == {1}


@pytest.mark.parametrize("after", [True, False])
def test_a_run_that_is_lost_asks_no_landed_request_again(crawl, monkeypatch, after):
    crawl.queue(range(20))
    plain, done = module.land_documents, []

    def lost(*args):
        # The third batch dies before it is landed, or after that but before it is noted.
        if len(done) == 2:
            if after:
                plain(*args)
            raise KeyError("lost")
        done.append(plain(*args))

    with monkeypatch.context() as broken:
        broken.setattr(module, "land_documents", lost)
        with pytest.raises(Exception, match="lost"):
            crawl()
    landed = crawl.landed()
    before = crawl.asked()
    assert len(landed) >= 9
    crawl()
    assert crawl.landed() == set(range(20)) - {13}
    again = {int(url.rpartition("/")[2]) for url, n in (crawl.asked() - before).items()}
    assert not again & landed


def test_batches_are_noted_together_and_the_landing_read_once(crawl, monkeypatch, tmp_path):
    # Name 3 comes twice; the later answer counts.
    crawl.queue([*range(90), 3])
    crawl.queue([3])
    reads, plain = [], module._landed_runs
    monkeypatch.setattr(module, "_landed_runs", lambda *args: reads.append(args) or plain(*args))
    assert crawl() == 20
    assert len(list((tmp_path / "checkpoint" / "commits").glob("[0-9]*"))) == 2 and len(reads) == 1
    assert crawl.landed() == set(range(90)) - {13}
    assert crawl.asked()["http://h0/3"] == 3


def test_what_was_written_down_is_landed_and_not_asked_again(crawl, monkeypatch):
    crawl.queue([13, 13, 13, 13, 13, *range(10)])

    def lost(*args):
        raise KeyError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(module, "add_runs", lost)
        with pytest.raises(Exception, match="lost"):
            crawl()
    before = crawl.asked()
    assert crawl.landed() == set() and sum(before.values()) == 15
    crawl()
    assert crawl.landed() == set(range(10)) and crawl.asked() == before


def test_requests_of_a_host_keep_their_pace(spark):
    def open_client():
        return lambda url: f"{url} {time.time()}"

    found = fetch_documents(requests(spark, range(24)), open_client, parallelism=3, pace=0.05).collect()
    for host in ("h0", "h1", "h2"):
        starts = sorted(float(r["body"].split()[1]) for r in found if f"//{host}/" in r["url"])
        assert len(starts) == 8 and all(b - a > 0.03 for a, b in zip(starts, starts[1:]))
