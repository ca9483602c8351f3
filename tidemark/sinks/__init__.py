"""Writers: catalog tables, zones and layouts."""
