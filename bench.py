"""Time every registered query of the library's own operators and print one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the number of local cores. The catalogue that the driver's tables are
turned into is made first and is part of no timing; ``star_build`` is the derivation of the star from it, and the key figures
are questions to that star.
"""

from __future__ import annotations

import json
import os
import sys
import time

from catalog_star.plans import kpis
from catalog_star.registry import QUERIES
from catalog_star.registry.roles import catalogue
from catalog_star.session import local_session
from catalog_star.staging import stage_scope

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))



def timed(name: str, run) -> float:
    start = time.perf_counter()
    run().write.format("noop").mode("overwrite").save()
    seconds = round(time.perf_counter() - start, 3)
    print(name, seconds, file=sys.stderr, flush=True)
    return seconds


def main() -> None:
    spark = local_session(cores=CPUS, app="catalog-star-bench")
    known = catalogue(spark, FOLDER)
    known.tracks_raw().count()  # also starts the session
    seconds = {"star_build": timed("star_build", lambda: known.star().fact)}
    for name, query in QUERIES.items():
        with stage_scope(spark) as scope:
            seconds[name] = timed(name, lambda: query.run(spark, FOLDER))
        if name not in ("award_summary", "merged_tracks"):  # these make stages of the catalogue
            scope.drop()
    star = known.star()
    seconds["all_key_figures"] = sum(
        timed(f.__name__, lambda: f(star))
        for f in (kpis.total_tracks, kpis.award_winning_artists, kpis.genres_by_winning_artists, kpis.popularity_and_danceability, kpis.audio_profile)
    )
    spark.stop()
    total = round(sum(seconds.values()), 3)
    scale = os.path.basename(FOLDER.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "total query time", "value": total, "unit": "sec", "queries": seconds, "sf": scale}))


if __name__ == "__main__":
    main()
