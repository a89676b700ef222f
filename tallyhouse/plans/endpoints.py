"""Access endpoints with their business unit, work roles and number of access types."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.operators import count_matches

col = F.col


def endpoint_listing(tables: Mapping[str, DataFrame], *, ordered: bool = True) -> DataFrame:
    """Every column of the endpoints, one row per work role that may use them, by business unit if ``ordered``."""
    endpoints = tables["Endpoint"]
    units = tables["BusinessUnit"].selectExpr("BusinessUnitId as unit_id", "Name as BUName")
    grants = tables["EndpointSecurity"].selectExpr(
        "EndpointID as granted_endpoint", "WorkRoleID as granted_role",
    )
    roles = tables["WorkRole"].selectExpr("WorkRoleID as role_id", "Name as WorkRole")
    # Counted on the endpoints, before they fan out over work roles.
    counted = count_matches(endpoints, tables["EndpointAccessType"], "EndpointID", "EndpointId", "Access")
    listed = (
        counted.join(units, F.expr("BusinessUnitID = unit_id"))
        .join(grants, F.expr("EndpointID = granted_endpoint"))
        .join(roles, F.expr("granted_role = role_id"))
        .select(*[col(f"`{name}`") for name in endpoints.columns], "BUName", "Access", "WorkRole")
    )
    return listed.orderBy("BusinessUnitID") if ordered else listed
