SELECT * FROM targets_all WHERE subject = 'Subject 8'
