"""SQL building blocks: the closed-form end states of the change logs in ``fixtures``."""

DEVICE = "'dev-' || (o_custkey % 4)"
NAME = "'branch-' || (o_custkey % 4)"
STATUS = (
    "CASE WHEN o_orderkey % 42 = 0 THEN 'Z' WHEN o_orderkey % 21 = 0 THEN 'R' "
    "WHEN o_orderkey % 5 = 0 THEN 'X' ELSE o_orderstatus END"
)
PRIORITY = "CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_orderpriority END"
ALIVE = "(o_orderkey % 7 <> 0 OR o_orderkey % 21 = 0)"
LAST_SEGMENT = (
    "CASE WHEN o_orderkey % 10 = 0 THEN 5 WHEN o_orderkey % 42 = 0 THEN 4 WHEN o_orderkey % 21 = 0 THEN 3 "
    "WHEN o_orderkey % 5 = 0 THEN 1 ELSE 0 END"
)


def commit(segment: str, key: str = "o_orderkey") -> str:
    return f"(1700000000000 + ({segment})::BIGINT * 1000000000 + {key})"


def at(millis: str) -> str:
    return f"make_timestamp(({millis}) * 1000)"


def orders_rows(
    status: str = STATUS,
    priority: str = PRIORITY,
    where: str = ALIVE,
    stamp: str | None = commit(LAST_SEGMENT),
    system: bool = True,
) -> str:
    devices = f"{DEVICE} AS sys_device_id, {NAME} AS sys_device_name, " if system else ""
    times = f"{at(stamp)} AS sys_update_ts, " if stamp and system else ""
    return (
        f"SELECT {devices}{times}o_orderkey, o_custkey, {status} AS o_orderstatus, o_totalprice, o_orderdate, "
        f"{priority} AS o_orderpriority FROM orders WHERE {where}"
    )


RULES = [
    (0, "INSERT", "TRUE"),
    (1, "UPDATE", "o_orderkey % 5 = 0"),
    (2, "DELETE", "o_orderkey % 7 = 0"),
    (3, "INSERT", "o_orderkey % 21 = 0"),
    (4, "UPDATE", "o_orderkey % 14 = 0"),
    (5, "UPDATE", "o_orderkey % 10 = 0"),
]


def orders_log(redelivered: bool = True) -> str:
    """CTE ``log``: one row per log row of L1."""
    parts = []
    for copies in ("TRUE", "o_orderkey % 11 = 0") if redelivered else ("TRUE",):
        for segment, op, rule in RULES:
            parts.append(
                f"SELECT {DEVICE} AS device_id, {NAME} AS device_name, {segment}::BIGINT AS segment, "
                f"o_orderkey AS seq, {commit(str(segment))} AS commit_id, '{op}' AS op, o_orderkey "
                f"FROM orders WHERE {rule} AND {copies}"
            )
    return "log AS (" + " UNION ALL ".join(parts) + ")"


MARKS = (
    "marks AS (SELECT device_id, device_name, max(segment) AS segment, max(commit_id) AS commit_id FROM log "
    "WHERE (device_id = 'dev-0' AND segment <= 1) OR (device_id = 'dev-1' AND segment <= 3) GROUP BY 1, 2)"
)


def total(column: str) -> str:
    return f"CAST(sum(CAST({column} AS DECIMAL(18,2))) AS DOUBLE)"
