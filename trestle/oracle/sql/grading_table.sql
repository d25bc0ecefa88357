select * from q_grading_long
