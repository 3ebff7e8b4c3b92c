"""The models, their incremental runs, and the pipeline that ties them together."""
