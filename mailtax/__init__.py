"""Sales-tax preparation for print-and-mail invoices, as PySpark DataFrame jobs."""
