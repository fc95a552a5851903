"""Image-stack analytics on Spark tables: load, clean, register, decompose, trace."""
