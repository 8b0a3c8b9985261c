"""Single operators, DataFrame in and DataFrame out; none of them runs a job unless it says so."""
