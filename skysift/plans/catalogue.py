"""All queries of the reference's operators."""

from skysift.plans import alerts, documents, frames, identity, ledger, payloads, risk, search, sinks, streams, upkeep

QUERIES, ORACLES = {}, {}
for _module in (frames, payloads, ledger, sinks, alerts, identity, risk, documents, search, upkeep, streams):
    QUERIES |= _module.query.queries
    ORACLES |= _module.query.oracles
