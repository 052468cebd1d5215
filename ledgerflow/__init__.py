"""ledgerflow: mailbox messages in, an auditable ledger of structured documents out.

Every operator takes and returns Spark DataFrames.  ``sources`` read the tables,
``operators`` hold the relational work, ``functions`` the column expressions,
``plans`` the assembled run and the registered queries, ``streaming`` the
micro-batch form of the run.
"""

from ledgerflow.session import configure, new_run_dir, session, shared_dir

__all__ = ["configure", "new_run_dir", "session", "shared_dir"]
