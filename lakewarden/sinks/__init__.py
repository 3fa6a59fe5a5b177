"""Writers: table append / overwrite, dataset copy and external-table registration."""
