"""School-records analytics as PySpark DataFrame products."""

from registrar.sources.catalog import SchoolCatalog
from registrar.sources.derived import DerivedSchool

__all__ = ["SchoolCatalog", "DerivedSchool"]
