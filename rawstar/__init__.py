"""rawstar: semi-structured raw tables to checked relational tables, on Spark."""

from rawstar.session import build_session, materialize, scratch_dir

__all__ = ["build_session", "materialize", "scratch_dir"]
