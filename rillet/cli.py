"""Command line: ``python -m rillet <job> --input ... --output ... [--option value ...]``.

Options are the fields of each job's dataclass (dashes or underscores);
tuple-valued ones take JSON (``--expected '[["Flourish", 3]]'``).  Under
``spark-submit`` the session comes from the submit; ``--master`` is for
local runs.  Stream jobs run until interrupted.
"""

from __future__ import annotations

import argparse
import dataclasses
import json
import sys
import typing

from rillet import model
from rillet.plans import jobs

BATCH = {
    "minimal_word_count": (jobs.minimal_word_count, model.WordCountOptions),
    "word_count": (jobs.word_count, model.WordCountOptions),
    "debugging_word_count": (jobs.debugging_word_count, model.DebuggingWordCountOptions),
    "windowed_word_count": (jobs.windowed_word_count, model.WindowedWordCountOptions),
    "user_score": (jobs.user_score, model.UserScoreOptions),
    "hourly_team_score": (jobs.hourly_team_score, model.HourlyTeamScoreOptions),
    "game_stats": (jobs.game_stats, model.GameStatsOptions),
    "stateful_team_score": (jobs.stateful_team_score, model.StatefulTeamScoreOptions),
    "person_records": (jobs.person_records, model.PersonOptions),
    "external_program": (jobs.external_program, model.ExternalProgramOptions),
}
STREAM = {
    "leader_board": (jobs.leader_board_stream, model.LeaderBoardOptions),
    "game_stats_stream": (jobs.game_stats_stream, model.GameStatsOptions),
    "stateful_team_score_stream": (jobs.stateful_team_score_stream, model.StatefulTeamScoreOptions),
    "windowed_word_count_stream": (jobs.windowed_word_count_stream, model.WindowedWordCountOptions),
    "person_records_stream": (jobs.person_records_stream, model.PersonOptions),
}


def _options(cls, argv: list[str]):
    hints = typing.get_type_hints(cls)
    p = argparse.ArgumentParser(prog=f"rillet {cls.__name__}")
    for f in dataclasses.fields(cls):
        required = f.default is dataclasses.MISSING and f.default_factory is dataclasses.MISSING
        p.add_argument(f"--{f.name.replace('_', '-')}", f"--{f.name}", dest=f.name, required=required,
                       default=None)
    ns = vars(p.parse_args(argv))
    kw = {}
    for f in dataclasses.fields(cls):
        raw = ns[f.name]
        if raw is None:
            continue
        t = str(hints[f.name])
        if "tuple" in t:
            kw[f.name] = tuple(tuple(x) if isinstance(x, list) else x for x in json.loads(raw))
        elif "int" in t:
            kw[f.name] = int(raw)
        elif "float" in t:
            kw[f.name] = float(raw)
        elif "bool" in t:
            kw[f.name] = raw.lower() in ("1", "true", "yes")
        else:
            kw[f.name] = raw
    return cls(**kw)


def main(argv: list[str] | None = None) -> int:
    argv = list(sys.argv[1:] if argv is None else argv)
    if not argv or argv[0] not in {**BATCH, **STREAM}:
        print("usage: python -m rillet <job> [options]\njobs: " + " ".join(sorted({**BATCH, **STREAM})))
        return 2
    name, rest = argv[0], argv[1:]
    master = None
    if "--master" in rest:
        i = rest.index("--master")
        master = rest[i + 1]
        rest = rest[:i] + rest[i + 2:]
    from pyspark.sql import SparkSession

    from rillet.session import build_session, clear_scratch

    own = SparkSession.getActiveSession() is None
    spark = build_session(master)
    if name in BATCH:
        fn, cls = BATCH[name]
        try:
            result = fn(spark, _options(cls, rest))
        finally:
            if own:                  # a caller's session may still read its intermediates
                clear_scratch(spark)
        if isinstance(result, dict):
            print(json.dumps(result))
        return 0
    fn, cls = STREAM[name]
    started = fn(spark, _options(cls, rest))
    for q in started if isinstance(started, tuple) else (started,):
        q.awaitTermination()
    return 0
