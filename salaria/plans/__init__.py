"""Physical decisions (join strategy, materialisation) and the report job."""
