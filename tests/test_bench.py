import json
import os

import bench


def test_event_log_attribution(tmp_path):
    events = [
        {"Event": "SparkListenerJobStart", "Stage IDs": [3, 4], "Properties": {"spark.jobGroup.id": "run:q:0"}},
        {"Event": "SparkListenerTaskEnd", "Stage ID": 3, "Task Metrics": {
            "Shuffle Write Metrics": {"Shuffle Bytes Written": 100},
            "Shuffle Read Metrics": {"Remote Bytes Read": 1, "Local Bytes Read": 2},
            "Memory Bytes Spilled": 5, "Disk Bytes Spilled": 7,
            "Executor Run Time": 11, "Executor CPU Time": 3_000_000}},
        {"Event": "SparkListenerTaskEnd", "Stage ID": 9, "Task Metrics": {"Executor Run Time": 99}},
    ]
    d = tmp_path / "app"
    d.mkdir()
    (d / "events_1").write_text("\n".join(json.dumps(e) for e in events) + "\nnot json\n")
    got = bench.read_event_log(str(tmp_path))
    assert dict(got["run:q:0"]) == {"shuffle_write_bytes": 100, "shuffle_read_bytes": 3, "memory_spill_bytes": 5,
                                   "disk_spill_bytes": 7, "executor_run_ms": 11, "executor_cpu_ms": 3, "tasks": 1}
    assert set(got) == {"run:q:0"}
    assert os.path.isdir(tmp_path)
