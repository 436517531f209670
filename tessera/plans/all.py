"""Import every plan module so its queries register."""

from tessera.plans import checks_fulfilment, checks_marts, checks_returns, checks_sales_gen, checks_survey, dims, facts, measures, sources  # noqa: F401
