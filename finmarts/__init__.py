"""Finance and sales marts on PySpark: raw ERP extracts in, reporting tables out."""
