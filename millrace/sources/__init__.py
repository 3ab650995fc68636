"""Reading exports: file assessment, CSV scans, schema checks."""
