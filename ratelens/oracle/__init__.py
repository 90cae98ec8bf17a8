"""SQL that computes the same results over the given tables, for checking only."""

from ratelens.oracle import agents, dashboard, delivery, health, ingest, market, newsletter, records

SQL: dict[str, str] = {
    **ingest.SQL,
    **market.SQL,
    **agents.SQL,
    **newsletter.SQL,
    **dashboard.SQL,
    **health.SQL,
    **delivery.SQL,
    **records.SQL,
}
