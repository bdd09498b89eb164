"""The role projections as common table expressions for the checking engine."""

from shopgrain.sources.roles import ROLES, SECOND_PARCELS, TRIPS, Role


def _select(role: Role) -> str:
    cols = ", ".join(f"{e} AS {n}" for n, e in role.columns.items()).replace("{ts}", "TIMESTAMP ")
    where = f" WHERE {role.where}" if role.where else ""
    return f"SELECT {'DISTINCT ' if role.distinct else ''}{cols} FROM {role.source}{where}"


_BODIES = {name: _select(role) for name, role in ROLES.items()}
_BODIES["shipments"] += " UNION ALL " + _select(SECOND_PARCELS)
_BODIES["trips"] = _select(TRIPS)


def with_roles(names: str, sql: str) -> str:
    """`sql` with the roles in `names` available as `r_<name>`.

    `sql` is either one SELECT, or further CTEs followed by it, marked by a leading 'WITH '.
    """
    ctes = ", ".join(f"r_{n} AS ({_BODIES[n]})" for n in names.split())
    if sql.lstrip().upper().startswith("WITH "):
        return f"WITH {ctes}, {sql.lstrip()[5:]}"
    return f"WITH {ctes} {sql}"
