"""Every operator of the library as a query over the given tables, with the same result in SQL."""

from queries import cleaning, incremental, keyed, raw, scans, trusted

CHECKS = {
    **scans.CHECKS,
    **incremental.CHECKS,
    **raw.CHECKS,
    **cleaning.CHECKS,
    **trusted.CHECKS,
    **keyed.CHECKS,
}
