"""rowtide: change data capture as PySpark jobs."""

from rowtide.spec import USERS, USERS_ISO, Field, TableSpec

__all__ = ["USERS", "USERS_ISO", "Field", "TableSpec"]
