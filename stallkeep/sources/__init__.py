from stallkeep.sources.contracts import CONTRACTS, Contract, contract_for
from stallkeep.sources.ingest import (
    ContractError,
    check_header,
    ingest,
    key_gate,
    load_table,
    scan_csv,
    typed,
)
from stallkeep.sources.store import Store

__all__ = [
    "CONTRACTS",
    "Contract",
    "ContractError",
    "Store",
    "check_header",
    "contract_for",
    "ingest",
    "key_gate",
    "load_table",
    "scan_csv",
    "typed",
]
