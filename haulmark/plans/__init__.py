"""Reports, jobs, feeds and the form workflow, composed from operators."""
