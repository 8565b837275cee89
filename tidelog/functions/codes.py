"""Operation codes of mined rows."""

#: The codes of the log-mining view.
INSERT, DELETE, UPDATE, DDL, START, COMMIT = 1, 2, 3, 5, 6, 7
SELECT_LOB_LOCATOR, LOB_WRITE, LOB_TRIM, SELECT_FOR_UPDATE, LOB_ERASE = 9, 10, 11, 25, 29
MISSING_SCN, ROLLBACK, UNSUPPORTED = 34, 36, 255
ROW_CODES = (INSERT, DELETE, UPDATE, SELECT_LOB_LOCATOR, LOB_WRITE, LOB_TRIM, LOB_ERASE, UNSUPPORTED)
TX_CODES = (START, COMMIT, ROLLBACK)
#: Schemas whose DDL is the system's own.
SYSTEM_OWNERS = """
SYS SYSTEM AUDSYS XDB OUTLN DBSNMP MDSYS CTXSYS ORDSYS WMSYS LBACSYS OJVMSYS GSMADMIN_INTERNAL DVSYS APPQOSSYS DBSFWUSER GGSYS
ANONYMOUS REMOTE_SCHEDULER_AGENT SYS$UMF DIP ORACLE_OCM XS$NULL ORDDATA OLAPSYS DVF PDBADMIN
""".split()
