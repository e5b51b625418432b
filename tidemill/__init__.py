"""tidemill - a library of analytics jobs written as DataFrame -> DataFrame functions."""
