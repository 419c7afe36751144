"""hostvane: host and process telemetry analytics as Spark DataFrame operators."""

from hostvane.session import get_session, work_dir

__all__ = ["get_session", "work_dir"]
