"""Every query of the engine by name, with the SQL it is held against."""

from . import boxes, filters, fusion, joins, metrics, tables, tracks

FLAGSHIP = "visible_objects"
MODULES = (tracks, boxes, joins, fusion, metrics, filters, tables)
QUERIES: dict = {}
ORACLE: dict = {}
for _m in MODULES:
    QUERIES |= _m.QUERIES
    ORACLE |= _m.ORACLE
