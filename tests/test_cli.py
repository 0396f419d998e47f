"""The command line end to end: CSV -> messages -> streaming detector -> lookups."""
import os
import subprocess
import sys
import uuid

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

CAMERAS = """camera_id,location_name,road_name,city,latitude,longitude,speed_limit_kph,camera_type
CAM-SPD,Speed Road - North,Speed Road,City,14.56,121.04,60,SPEED
CAM-INT,Cross Road - East,Cross Road,City,14.58,121.05,60,INTERSECTION
"""
TELEMETRY = """event_id,camera_id,plate_number,vehicle_type,latitude,longitude,speed_kph,traffic_light_state,stop_line_crossed,event_time
a,CAM-SPD,abc 1,CAR,14.5,121.0,90,,,2026-09-01 07:00:01
b,CAM-SPD,abc 1,CAR,14.5,121.0,95,,,2026-09-01 07:00:02
c,CAM-INT,xyz 2,BUS,14.5,121.0,40,red,yes,2026-09-01 07:00:03
d,CAM-INT,zzz 9,CAR,14.5,121.0,10,green,yes,2026-09-01 08:00:03
"""


def cli(*args):
    out = subprocess.run([sys.executable, "-m", "trafficwatch", *args], cwd=ROOT,
                         capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    return out.stdout


def test_publish_detect_and_look_up(tmp_path):
    (tmp_path / "cams.csv").write_text(CAMERAS)
    (tmp_path / "t.csv").write_text(TELEMETRY)
    msgs, store = str(tmp_path / "msgs"), str(tmp_path / "store")
    cli("publish", "--csv", str(tmp_path / "t.csv"), "--out", msgs)
    parts = [f for f in os.listdir(msgs) if f.startswith("part-")]
    assert sum(len(open(os.path.join(msgs, f)).read().splitlines()) for f in parts) == 4
    logged = cli("detect", "--registry", str(tmp_path / "cams.csv"), "--input", msgs,
                 "--store", store, "--stage", str(tmp_path / "readings"), "--available-now",
                 "--dedupe", "--normalize-plates",
                 "--job", f"cli-test-{uuid.uuid4().hex[:12]}")
    assert "[red_light_violations] batch" in logged
    by_type = cli("lookup", "--type", "beating_red_light", "--day", "2026-09-01", "--store", store)
    assert "XYZ 2" in by_type and "BUS" in by_type
    assert "version 1" in cli("compact", "--store", store)
    by_plate = cli("lookup", "--plate", "ABC 1", "--store", store)  # from the compacted version
    assert by_plate.count("SPEEDING") >= 1
    stats = cli("lookup", "--camera", "cam-spd", "--stats", "--day", "2026-09-01", "--store", store)
    assert "92.5" in stats
    wrong = subprocess.run([sys.executable, "-m", "trafficwatch", "lookup", "--plate", "X", "--store", store + "x"],
                           cwd=ROOT, capture_output=True, text=True, timeout=600)
    assert wrong.returncode != 0 and "no violation store" in wrong.stderr


def test_runs_without_a_configured_checkpoint_folder(tmp_path):
    """With no spark.checkpoint.dir (no spark-defaults), a local folder is used
    for stream checkpoints and DataFrame.checkpoint(); the setting is not written."""
    empty_conf = tmp_path / "conf"
    empty_conf.mkdir()
    code = (
        "import sys; sys.path.insert(0, %r)\n"
        "from trafficwatch.session import get_session, checkpoint_root\n"
        "spark = get_session('local[2]')\n"
        "assert spark.conf.get('spark.checkpoint.dir', None) is None\n"
        "root = checkpoint_root(spark)\n"
        "assert checkpoint_root(spark) == root\n"
        "assert spark.range(5).checkpoint().count() == 5\n"
        "import bench\n"
        "assert bench.stream_run(spark, '/root/testdata/sf0.001') > 0\n"
        "print('ok', root)\n" % ROOT
    )
    env = {**os.environ, "SPARK_CONF_DIR": str(empty_conf)}
    out = subprocess.run([sys.executable, "-c", code], cwd=ROOT, env=env,
                         capture_output=True, text=True, timeout=600)
    assert out.returncode == 0 and "ok" in out.stdout, out.stderr[-2000:]


def test_bench_prints_one_json_line():
    import json

    env = {**os.environ, "BENCH_SF_DIR": "/root/testdata/sf0.001", "BENCH_REPEAT": "1"}
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], cwd="/tmp", env=env,
                         capture_output=True, text=True, timeout=900)
    assert out.returncode == 0, out.stderr[-2000:]
    lines = [line for line in out.stdout.splitlines() if line.strip()]
    assert len(lines) == 1
    result = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(result)
    assert result["unit"] == "sec" and result["sf"] == 0.001 and "stream_job" in result["queries"]
