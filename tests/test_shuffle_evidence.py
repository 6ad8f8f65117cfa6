"""keep_first never hands a hot key's whole group to one reduce task
(measured from the event log of a separate local session)."""

import json
import os
import subprocess
import sys

HERE = os.path.dirname(os.path.abspath(__file__))


def test_hot_key_is_limited_before_the_shuffle():
    out = subprocess.run([sys.executable, os.path.join(HERE, "shuffle_evidence.py")],
                         capture_output=True, text=True, timeout=600, check=True).stdout
    m = json.loads(out.strip().splitlines()[-1])
    hot, rows = m["hot_key_rows"], m["rows"]
    assert m["shuffle_records_written"]["keep_first"] < rows
    assert m["max_records_read_by_one_task"]["keep_first"] < hot
    # without the map-side limit the hot group lands in one task
    assert m["max_records_read_by_one_task"]["without_partial_limit"] >= hot
    # the fewer keys repeat, the less a sieved keep_first shuffles
    b = m["shuffle_bytes_written"]
    assert b["sieve_100"] < b["sieve_90"] < b["sieve_50"] < b["sieve_0"]
    assert b["sieve_100"] < 0.1 * b["sieve_off"] and b["sieve_90"] < 0.3 * b["sieve_off"]
    # four codes: no task of the salted join reads more than twice the median
    plain, salted = m["lookup_tasks"]["lookup_plain"], m["lookup_tasks"]["lookup_salted"]
    assert salted["largest"] <= 2 * salted["median"] and salted["tasks"] >= 12
    assert plain["largest"] > 4 * salted["largest"]
