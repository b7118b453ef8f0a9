"""convoloom: lazy DataFrame operators that build, curate and reshape tool-use conversation data on Spark."""
