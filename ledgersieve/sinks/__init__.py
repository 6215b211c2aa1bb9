"""Writers: exports, audit and metrics appends, promotion to an external warehouse."""
