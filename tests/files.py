"""Small files with the shapes agents leave behind."""

import csv
import io
from datetime import datetime, timedelta

from hostvane import schemas

HEADER = [name for name, _ in schemas.AGENT_COLUMNS]
MACHINE = "0a1b2c3d4e5f"
START = datetime(2031, 2, 7, 6, 10, 0, 500000)


def agent_fields(i: int, count: int | None = None, processes: str = "[]") -> list[str]:
    ts = (START + timedelta(seconds=5 * i)).isoformat()
    row = ["0a:1b:2c:3d:4e:5f", "bruno", str(i % 100), "2500.0", "800.0", "3100.0", "34359738368", "25769803776", "25.0"]
    row += ["1073741824", "268435456", "805306368", "7", "9", "25.0", "128000000000", "32000000000", "96000000000", "25.0"]
    row += ["512", "1024", "21", "700", "900", processes]
    return [*row, ts] if count is None else [*row, str(count), ts]


def agent_list(pid: int) -> str:
    return (
        f"[{{'pid': {pid}, 'name': 'vela.exe', 'status': 'sleeping', 'num_threads': 4, 'memory_percent': 1.25, "
        r"'exe': 'D:\\Tools (old)\\vela.exe', 'cmdline': ['vela.exe', '--port=9090'], 'username': 'LAB\\bruno', "
        "'memory_info': pmem(rss=410000000, vms=530000000), 'cpu_times': pcputimes(user=2.5, system=0.75), "
        "'cpu_percent': 1.5, 'create_time': 1927000000.25}]"
    )


def text(rows: list[list[str]], header: list[str] | None = None) -> str:
    out = io.StringIO()
    writer = csv.writer(out, lineterminator="\n")
    for row in ([header] if header else []) + rows:
        writer.writerow(row)
    return out.getvalue()


def mixed_rows() -> list[list[str]]:
    """27 samples: 20 of the older version, then 7 of the newer, the last 5 of which hold a process."""
    older = [agent_fields(i) for i in range(20)]
    newer = [agent_fields(i, 0) for i in range(20, 22)]
    return older + newer + [agent_fields(i, 1, agent_list(500 + i)) for i in range(22, 27)]


def write_landing(folder) -> str:
    """With a header, without one, and overlapping: 20 + 7 + 9 rows."""
    rows = mixed_rows()
    day = folder / "raw" / "2031" / "02" / "07"
    day.mkdir(parents=True)
    uploads = [("06-12-00", rows[:20], HEADER), ("06-13-00", rows[20:], None), ("06-14-00", rows[18:], None)]
    for time, chosen, header in uploads:
        (day / f"dados_2031-02-07T{time}_{MACHINE}.csv").write_text(text(chosen, header))
    return str(folder / "raw")
