"""Sales-mart engine on PySpark: daily sales files in, monthly data marts out."""
