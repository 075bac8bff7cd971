"""The landing stream: races arrive, and replace what is stored of them."""

import json

from paceline import schemas
from paceline.sources.landed import race_results
from paceline.sources.tables import read_table
from paceline.streaming.landing import keep_current, stream_responses
from tests.helpers import rows
from tests.test_sources import entry, race, response


def test_landing(spark, tmp_path):
    landing, table, marks = (str(tmp_path / n) for n in ("landing", "table", "marks"))
    (tmp_path / "landing").mkdir()

    def land(name, season, *positions, first=1):
        lines = [json.dumps(response([race(season, i + first, Results=[entry("A", "B", "1", p)])])) for i, p in enumerate(positions)]
        (tmp_path / "landing" / name).write_text("\n".join(lines))
        stream = keep_current(race_results(stream_responses(spark, landing)), table, marks, ["round"])
        stream.trigger(availableNow=True).start().awaitTermination()
        return rows(read_table(spark, table, schemas.RESULTS), "year", "round", "position")

    assert land("a.json", 2021, "1", "2") == [(2021, 1, 1.0), (2021, 2, 2.0)]
    assert land("b.json", 2022, "5") == [(2021, 1, 1.0), (2021, 2, 2.0), (2022, 1, 5.0)]
    assert land("c.json", 2021, "3", "4", "R") == [(2021, 1, 3.0), (2021, 2, 4.0), (2021, 3, None), (2022, 1, 5.0)]
    # a season that lands in several batches keeps the races of each
    after = land("d.json", 2021, "6", "7", first=2)
    assert after == [(2021, 1, 3.0), (2021, 2, 6.0), (2021, 3, 7.0), (2022, 1, 5.0)]
